"""The batch steps on files as they arrive.

A file source with a checkpoint takes each file once. Its batches are replayed
with the same number after a failure, so every sink here is keyed by batch
number or is an upsert that a replay leaves unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfold.config import HistoryConfig
from tallyfold.functions import text as X
from tallyfold.operators import extract, filecheck
from tallyfold.operators.history import LOADED, newest
from tallyfold.operators.joins import lookup_stored
from tallyfold.session import materialise, scratch
from tallyfold.sources import commits, sinks, tables


def line_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    folder: str | None = None,
    archive: str | None = None,
) -> DataFrame:
    """(file, value) of arriving extracts.

    A file is one extract. With `folder` all files below a <folder>=<name>
    directory are; they must then arrive together and be taken in one batch
    (`assembly` takes them in parts). Files that were taken are moved below
    `archive`, if given, once a later batch has begun.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    name = F.col("_metadata.file_path")
    if folder:
        name = F.regexp_extract(name, rf"/{folder}=([^/]+)/", 1)
    return reader.text(path).select(name.alias("file"), "value")


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def check_and_route(lines: DataFrame, out: str, batch: int, folder: str | None = None) -> None:
    """Check results to checks/batch=<n>, records to records/batch=<n>.

    With `folder` the lines come under the paths of their files, and all files
    below a <folder>=<name> directory are one extract. A path is turned into the
    extract's name once for each count and not for each line, which would cost more
    than to read the line; records look up the name with their status.
    """
    name = F.regexp_extract("file", rf"/{folder}=([^/]+)/", 1) if folder else F.col("file")
    recs = extract.records(lines)
    with scratch():
        counted = materialise(filecheck.counted(extract.tagged(lines)), "tallies")
        checks = filecheck.check_counted(counted.withColumn("file", name))
        checks.write.mode("overwrite").parquet(f"{out}/checks/batch={batch}")
        stored = lines.sparkSession.read.schema(checks.schema).parquet(f"{out}/checks/batch={batch}")
        if folder:
            paths = counted.select(F.col("file").alias("path"), name.alias("file"), "rec_type").distinct()
            totals = materialise(paths.join(stored.drop("actual"), ["file", "rec_type"]), "totals")
            routed = lookup_stored(recs.withColumnRenamed("file", "path"), totals, ["path", "rec_type"])
            routed = routed.select("file", "rec_type", "line", "declared", "status")
        else:
            routed = filecheck.routed(recs, stored)
        sinks.write_routed(routed, f"{out}/records/batch={batch}", rebalance=True)


def ingest(
    stream: DataFrame, out: str, checkpoint: str, every: str | None = None, folder: str | None = None
) -> StreamingQuery:
    """Check and route every arriving extract.

    Records go to records/batch=<n>, check results to checks/batch=<n>; a replayed
    batch overwrites its own folder. `every` is a period such as "2 minutes";
    without one, what is there is processed and the stream ends. `folder` names the
    directories that make an extract, for a stream of lines under their paths; files
    of an extract must then arrive together.
    """

    def work(lines: DataFrame, batch: int) -> None:
        check_and_route(lines, out, batch, folder)

    return _start(stream, work, checkpoint, every)


def arrivals(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """(key, bucket, at, message) of arriving files, as a stream. Only the listing is used."""
    listed = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(listed).option("recursiveFileLookup", "true")
    stream = reader.load(path)
    return arrival_log(stream.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified")), root or path)


def arrival_log(files: DataFrame, root: str) -> DataFrame:
    """Arrival messages of listed files: object key below its root, and time."""
    bucket = F.coalesce(F.nullif(X.url_bucket(F.lit(root)), F.lit("")), X.base_name(F.lit(root.rstrip("/"))))
    key = F.substring_index("file", root.rstrip("/") + "/", -1)
    at = F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return files.select(
        key.alias("key"), bucket.alias("bucket"), at.alias("at"), X.arrival_message(key, bucket, at).alias("message")
    )


def log_arrivals(spark: SparkSession, path: str, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append one message per arriving file; the file sink drops replays itself."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    log = arrivals(spark, path).writeStream.format("parquet").option("path", out)
    return log.option("checkpointLocation", checkpoint).trigger(**trigger).start()


#: Changed rows of keyed upserts, a folder for each micro-batch.
CHANGED = "changed"


def upsert_changes(
    stream: DataFrame, table: str, cfg: HistoryConfig, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """The newest row of each key and load date, kept in the state of the stream.

    A micro-batch writes only the rows that it changed, to changed/batch=<n>, so
    what is written follows the batch and not the dates it touches. `latest` reads
    the table, `fold` turns what has been written into an append history. State is
    a row for each key and date: with many, the session should use the state store
    on RocksDB.
    """
    identity = [LOADED, *[k for k in cfg.primary_keys if k != LOADED]]
    order = F.struct(*[F.col(c) for c in (cfg.batch_date, *cfg.tie_breakers)])
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    best = stream.groupBy(*identity).agg(F.max_by(row, order).alias("row")).select("row.*")

    def work(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{table}/{CHANGED}/batch={batch}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = best.writeStream.outputMode("update").foreachBatch(work)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def latest(spark: SparkSession, table: str, cfg: HistoryConfig, after: int = -1) -> DataFrame:
    """The rows as the last micro-batch left them; of those after a batch only, if given."""
    identity = [LOADED, *[k for k in cfg.primary_keys if k != LOADED]]
    changed = spark.read.option("mergeSchema", "true").parquet(f"{table}/{CHANGED}").where(F.col("batch") > after)
    return newest(changed, identity, ["batch"]).drop("batch")


def fold(spark: SparkSession, table: str, history: str, cfg: HistoryConfig, after: int = -1) -> int:
    """Bring the rows that changed after a micro-batch into an append history; returns the last one, to go on from."""
    last = [int(n.split("=")[1]) for n in commits.children(spark, f"{table}/{CHANGED}") if n.startswith("batch=")]
    if last and max(last) > after:
        tables.upsert_append(spark, history, latest(spark, table, cfg, after), cfg)
        return max(last)
    return after


def upsert_arrivals(
    stream: DataFrame, table: str, cfg: HistoryConfig, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep an append history up to date from arriving rows.

    Files of one period may come in any order, so the newest row wins by the
    batch date and not by arrival; that also makes a replay harmless.
    """

    def work(rows: DataFrame, batch: int) -> None:
        tables.upsert_append(rows.sparkSession, table, rows, cfg, compare_stored=True)

    return _start(stream, work, checkpoint, every)
