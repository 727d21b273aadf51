"""A ledger of checked extracts, so that each is read once and then moved away.

A run takes the extracts of the landing folder that the ledger does not name,
checks and routes them, writes their status down and moves them below
archive/<status>. What a lost run left is done by the next one: extracts without
a status are checked again into the same folder, extracts with one are moved.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators import filecheck
from tallyfold.plans import batch
from tallyfold.session import scratch
from tallyfold.sources import commits, readers, sinks

LEDGER = "file string, status string, n_records long, run string"


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """(file, status, n_records, run) of all extracts checked so far."""
    schema = spark.createDataFrame([], LEDGER).schema
    return readers.read_parquet(spark, ledger, schema, missing="skip").select("file", "status", "n_records", F.col("run").cast("string"))


def pending(spark: SparkSession, landing: str, ledger: str, folder: str) -> list[str]:
    """Names of the extracts that lie in the landing folder and have no status."""
    if not commits.exists(spark, landing):
        return []
    files = readers.file_names(spark, landing).select(F.regexp_extract("file", rf"/{folder}=([^/]+)/", 1).alias("file"))
    new = files.where("file <> ''").distinct().join(entries(spark, ledger), "file", "left_anti")
    return sorted(unquote(r["file"]) for r in new.collect())


def move_checked(spark: SparkSession, landing: str, ledger: str, archive: str, folder: str) -> list[str]:
    """Move extracts that have a status out of the landing folder, a rename each; returns their names."""
    here = {n.split("=", 1)[1]: n for n in commits.children(spark, landing) if n.startswith(f"{folder}=")}
    if not here:
        return []
    done = entries(spark, ledger).where(F.col("file").isin(list(here))).select("file", "status").collect()
    moved = []
    for file, status in sorted((r["file"], r["status"]) for r in done):
        if commits.claim(spark, f"{landing}/{here[file]}", f"{archive}/{status}/{here[file]}"):
            moved.append(file)
    return moved


def check_new(spark: SparkSession, landing: str, out: str, ledger: str, archive: str, folder: str, run: str) -> DataFrame:
    """Check, route and move the extracts that are new; returns this run's checks.

    Records go to <out>/run=<run>. Each extract is a folder below <landing>; their
    names are what passes through the driver. An extract fails if a type of it
    does, or if it has no record.
    """
    move_checked(spark, landing, ledger, archive, folder)
    names = pending(spark, landing, ledger, folder)
    if not names:
        return spark.createDataFrame([], "file string, rec_type string, actual long, declared long, status string")
    lines = spark.read.text([f"{landing}/{folder}={n}" for n in names])
    lines = lines.select(F.regexp_extract(F.col("_metadata.file_path"), rf"/{folder}=([^/]+)/", 1).alias("file"), "value")
    files = spark.createDataFrame([(n,) for n in names], "file string")
    checks = batch.check_and_route(lines, f"{out}/run={run}", files=files)
    with scratch():
        failed = F.bool_or(F.col("status") == filecheck.FAIL)
        status = F.when(failed, filecheck.FAIL).otherwise(filecheck.PASS)
        of_file = checks.groupBy("file").agg(status.alias("status"), F.sum("actual").alias("n_records"))
        of_file.coalesce(1).write.mode("overwrite").parquet(f"{ledger.rstrip('/')}/run={run}")
    move_checked(spark, landing, ledger, archive, folder)
    return checks


def records(spark: SparkSession, out: str, ledger: str) -> DataFrame:
    """Routed records of the runs that the ledger names; a run that was lost before is not read."""
    runs = [r["run"] for r in entries(spark, ledger).select("run").distinct().collect()]
    parts = [f"{out.rstrip('/')}/run={r}" for r in sorted(runs)]
    parts = [p for p in parts if commits.exists(spark, p)]
    if not parts:
        return spark.createDataFrame([], sinks.ROUTED + ", run string")
    reader = spark.read.schema(sinks.ROUTED + ", run string").option("basePath", out)
    return reader.parquet(*parts)
