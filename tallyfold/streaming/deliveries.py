"""Files that are delivered again, under the same contents and another name.

A ledger takes every arriving file whose size and contents no file within the
time span before had. What feeds on the ledger counts a repeated file once; what
the ledger did not take is told apart by `report`.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyfold.sources import readers
from tallyfold.streaming.arrivals import _start, check_and_route

LEDGER = "file string, modified timestamp, bytes long, digest string"
TAKEN, REPEATED, LATE, PENDING = "taken", "repeated", "late", "pending"


def _digest(content: Column) -> Column:
    return F.sha2(content, 256).alias("digest")


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(file, modified, bytes, digest) of arriving files. A file passes through the memory of one task."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = reader.schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    return found.select(
        F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), _digest(F.col("content"))
    )


def first_deliveries(files: DataFrame, within: str) -> DataFrame:
    """The files that are no repetition; state is kept for the time span `within`, and files older than that are not taken."""
    return files.withWatermark("modified", within).dropDuplicatesWithinWatermark(["bytes", "digest"])


def log_deliveries(
    spark: SparkSession, path: str, ledger: str, checkpoint: str, within: str, every: str | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Add the files that arrive first to the ledger; the file sink drops replays itself."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    log = first_deliveries(file_stream(spark, path, files_per_batch), within).writeStream.format("parquet").option("path", ledger)
    return log.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def report(spark: SparkSession, path: str, ledger: str, within: str) -> DataFrame:
    """(file, status, like): every file of the landing folder.

    "taken" files are in the ledger; "repeated" ones have the contents of the file
    `like`; "late" ones were older than the time span when they came, "pending"
    ones have yet to be looked at. Only files that were not taken are read.
    """
    known = readers.read_parquet(spark, ledger, spark.createDataFrame([], LEDGER).schema, missing="skip")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    listed = listed.select(
        F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), "content"
    )
    taken = known.select("file", F.lit(TAKEN).alias("status"), F.lit(None).cast("string").alias("like"))
    others = listed.join(known.select("file"), "file", "left_anti").select("file", "modified", "bytes", _digest(F.col("content")))
    first = known.groupBy("bytes", "digest").agg(F.min_by("file", "modified").alias("like"))
    latest = known.agg(F.max("modified").alias("latest"))
    others = others.join(first, ["bytes", "digest"], "left").join(F.broadcast(latest))  # one row
    late = F.col("modified") < F.col("latest") - F.expr(f"INTERVAL {within}")
    status = F.when(F.col("like").isNotNull(), REPEATED).when(late, LATE).otherwise(PENDING)
    return taken.unionByName(others.select("file", status.alias("status"), "like"))


def delivered_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(file, value) of the lines of listed files, whose paths pass through the driver."""
    names = [unquote(r["file"]) for r in files.select("file").distinct().collect()]
    if not names:
        return spark.createDataFrame([], readers.LINES)
    return spark.read.text(names).select(F.col("_metadata.file_path").alias("file"), "value")


def ingest_ledger(
    spark: SparkSession, ledger: str, out: str, checkpoint: str, folder: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Check and route the files that the ledger takes, each once, as `arrivals.ingest` does."""

    def work(files: DataFrame, batch: int) -> None:
        check_and_route(delivered_lines(files.sparkSession, files), out, batch, folder)

    return _start(spark.readStream.schema(LEDGER).parquet(ledger), work, checkpoint, every)
