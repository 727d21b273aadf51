"""Writing split records, routed records and check results.

By default no write shuffles: every task writes its share of each target folder,
so a type or status that holds most of the rows is written by many tasks. With
`rebalance`, rows are first brought together by folder into files of ordinary size;
Spark splits folders that are larger, so a type is still not one task's work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import text as X
from tallyfold.operators.columns import OUTCOME_COLUMNS
from tallyfold.operators.extract import split_lines


# Schemas of what is written here. Types are spelled out on reading, so that a
# record type such as 0900 stays the text it is.
SPLIT = "file string, line string, declared bigint, rec_type string"
SPLIT_TEXT = "value string, rec_type string"
ROUTED = "file string, line string, declared bigint, status string, rec_type string"


def hour_path(run_ts: dt.datetime) -> str:
    return run_ts.strftime("%Y/%m/%d/%H")


def _dated(path: str, run_date: dt.date | str | None) -> str:
    """The folder of a run date. Each write replaces its own folder and no other."""
    return path if run_date is None else f"{path.rstrip('/')}/dt={run_date}"


def write_split_text(
    recs: DataFrame, path: str, run_date: dt.date | str | None = None, with_total: bool = True, by_file: bool = True
) -> None:
    """Text per record type, each line with its declared total behind it.

    `by_file` keeps the lines of each extract in a folder of their own, so several
    extracts of a day do not overwrite one another.
    """
    lines = split_lines(recs) if with_total else recs.withColumn("value", F.col("line"))
    folders = ["rec_type"]
    if by_file:
        lines = lines.withColumn("extract", X.base_name(F.col("file")))
        folders.append("extract")
    lines.select(*folders, "value").write.mode("overwrite").partitionBy(*folders).text(_dated(path, run_date))


def write_split(
    recs: DataFrame, path: str, run_date: dt.date | str | None = None, rebalance: bool = False
) -> None:
    """Split records as a columnar table; the extract stays a column."""
    rows = recs.hint("rebalance", "rec_type") if rebalance else recs
    rows.write.mode("overwrite").partitionBy("rec_type").parquet(_dated(path, run_date))


def read_split(
    spark: SparkSession, path: str, text: bool = False, dated: bool = False, by_file: bool = True
) -> DataFrame:
    schema = SPLIT_TEXT + (", extract string" if by_file else "") if text else SPLIT
    reader = spark.read.schema(schema + (", dt date" if dated else ""))
    return reader.text(path) if text else reader.parquet(path)


def write_routed(
    recs: DataFrame, path: str, run_ts: dt.datetime | None = None, rebalance: bool = False
) -> None:
    """Records under status=pass|fail/rec_type=...; with a run time under its hour."""
    target = f"{path.rstrip('/')}/{hour_path(run_ts)}" if run_ts else path
    if rebalance:
        recs = recs.hint("rebalance", "status", "rec_type")
    recs.write.mode("overwrite").partitionBy("status", "rec_type").parquet(target)


def read_routed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROUTED).parquet(path)


def _cells(width: int) -> list[str]:
    return [f"_c{i}" for i in range(width)]


def write_quarantined(rows: DataFrame, path: str, width: int) -> None:
    """Quarantined lines as comma-separated text of `width` columns, under
    status=good|bad/rec_type=...; what was there is replaced."""
    parts = X.fields(F.col("value"))
    cells = [F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(_cells(width))]
    rows.select("status", "rec_type", *cells).write.mode("overwrite").partitionBy("status", "rec_type").csv(path)


def read_quarantined(spark: SparkSession, path: str, width: int) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in [*_cells(width), "status", "rec_type"])
    return spark.read.schema(schema).csv(path)


#: Column that tells of lines the typed read could not take as they are.
MALFORMED = "malformed_record"


def write_outcomes(outcomes: DataFrame, path: str, mode: str = "append", quarantine: bool = False) -> None:
    """Row outcomes of a record check, passed and failed rows in folders of their
    own, in one pass over the data. With `quarantine` rows that have a malformed
    record go to a third one, whatever the rules say of them."""
    result = F.col(OUTCOME_COLUMNS[3])
    status = F.when(result == "Passed", "pass").otherwise("fail")
    if quarantine:
        status = F.when(F.col(MALFORMED).isNotNull(), "malformed").otherwise(status)
    outcomes.withColumn("status", status).write.mode(mode).partitionBy("status").parquet(path)


def read_malformed(spark: SparkSession, path: str) -> DataFrame:
    """(line, reason, status) of the malformed records among stored outcomes."""
    schema = f"{MALFORMED} struct<line: string, reason: string>, status string"
    return spark.read.schema(schema).parquet(path).where(F.col(MALFORMED).isNotNull()).select(f"{MALFORMED}.*", "status")


def write_wide(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
