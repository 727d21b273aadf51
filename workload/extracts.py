"""Landing files, splitting, footers and the file check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import text as X
from tallyfold.operators import extract, filecheck
from tallyfold.plans import batch
from tallyfold.session import new_folder
from tallyfold.sources import readers, sinks
from workload.views import landing, lines, table, with_lines

RUN_DATE = dt.date(2024, 9, 2)


def landing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.landing_files(spark, landing(spark, sf_dir))
    name = F.substring_index(X.folder_name(F.col("file")), "=", -1)
    return found.groupBy(name.alias("file")).agg(
        F.bool_and(X.base_name(F.col("file")).startswith("part-")).alias("is_part"), F.sum("bytes").alias("bytes")
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir)


def segregate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = extract.records(lines(spark, sf_dir))
    key = F.element_at(X.fields(F.col("line")), 2)
    return recs.select("file", "rec_type", key.alias("k"), "line")


def rec_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.type_counts(extract.records(lines(spark, sf_dir)))


def rec_type_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.type_list(extract.records(lines(spark, sf_dir)))


def rec_type_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.of_type(extract.records(lines(spark, sf_dir)), "9005").select("file", "line")


def footer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filecheck.declared_totals(lines(spark, sf_dir))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = lines(spark, sf_dir)
    recs = extract.with_footers(extract.records(src), extract.footers(src))
    return extract.split_lines(recs)


def segregate_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.segregate(lines(spark, sf_dir), new_folder(spark, "split"), RUN_DATE, text=True)


def reference_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.reference_row(_split(spark, sf_dir))


def checksum_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filecheck.check_lines(lines(spark, sf_dir))


def checksum_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filecheck.check_split(_split(spark, sf_dir))


def checksum_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, run_ts = new_folder(spark, "routed"), dt.datetime(2024, 9, 2, 7, 30)
    batch.check_and_route(lines(spark, sf_dir), path, run_ts)
    return sinks.read_routed(spark, f"{path}/{sinks.hour_path(run_ts)}").drop("declared")


def empty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of a landing folder in which one extract came as a file without a byte."""
    path = new_folder(spark, "landing_empty")
    lines(spark, sf_dir).write.partitionBy("file").text(path)
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/file=extract_none")
    name = F.substring_index(X.folder_name(F.col("file")), "=", -1)
    files = readers.file_names(spark, path).select(name.alias("file"))
    return batch.check_and_route(readers.read_lines(spark, path, folder="file"), new_folder(spark, "routed"), files=files)


def hour_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    path = new_folder(spark, "hours")
    events = table(spark, sf_dir, "events").select("event_id", X.hour_folder(ts).alias("hour"), F.date_format(ts, "yyyy-MM-dd").alias("day"))
    events.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path).groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n"))


def null_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, every seventh with an empty second field, every eleventh without one."""
    key = F.col("o_orderkey")
    second = F.when(key % 7 == 0, F.lit("")).otherwise(key.cast("string"))
    line = F.when(key % 11 == 0, F.lit("9005")).otherwise(F.concat_ws("|", F.lit("9005"), second, F.col("o_orderpriority")))
    return table(spark, sf_dir, "orders").select(F.lit("orders").alias("file"), line.alias("value"))


def null_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "quarantine")
    sinks.write_quarantined(filecheck.quarantined(null_lines(spark, sf_dir)), path, 3)
    return sinks.read_quarantined(spark, path, 3)


QUERIES = {
    "landing_files": landing_files,
    "raw_lines": raw_lines,
    "segregate_records": segregate_records,
    "rec_type_counts": rec_type_counts,
    "rec_type_list": rec_type_list,
    "rec_type_select": rec_type_select,
    "footer_parse": footer_parse,
    "segregate_write": segregate_write,
    "reference_row": reference_row,
    "checksum_status": checksum_status,
    "checksum_split": checksum_split,
    "checksum_route": checksum_route,
    "empty_files": empty_files,
    "hour_partition": hour_partition,
    "null_split": null_split,
}

_SPLIT = """
, declared AS (
  SELECT r.file, r.rec_type, r.line, CASE WHEN r.extract % 4 <> 2 THEN coalesce(t.declared, 0) END AS declared
  FROM recs r LEFT JOIN totals t USING (file, rec_type)
)
"""

ORACLE = {
    "landing_files": with_lines(
        "SELECT file, true AS is_part, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes FROM landed GROUP BY file"
    ),
    "raw_lines": with_lines("SELECT file, value FROM landed"),
    "segregate_records": with_lines("SELECT file, rec_type, k, line FROM recs"),
    "rec_type_counts": with_lines("SELECT rec_type, count(*) AS n FROM recs GROUP BY rec_type"),
    "rec_type_list": with_lines("SELECT DISTINCT rec_type FROM recs"),
    "rec_type_select": with_lines("SELECT file, line FROM recs WHERE rec_type = '9005'"),
    "footer_parse": with_lines("SELECT file, rec_type, CAST(declared AS BIGINT) AS declared FROM totals"),
    "segregate_write": with_lines(
        _SPLIT
        + """SELECT DATE '2024-09-02' AS dt, rec_type, file AS extract, line || '|' || coalesce(CAST(declared AS VARCHAR), '') AS value
             FROM declared"""
    ),
    "reference_row": with_lines(
        _SPLIT
        + """SELECT file, max(rec_type) AS rec_type, CAST(arg_max(declared, rec_type) AS BIGINT) AS reference_count
             FROM declared GROUP BY file"""
    ),
    "empty_files": with_lines(
        """SELECT file, rec_type, actual, declared, status FROM checked
           UNION ALL SELECT 'extract_none', NULL, 0, 0, 'fail'"""
    ),
    "checksum_status": with_lines(
        "SELECT file, rec_type, actual, CAST(declared AS BIGINT) AS declared, status FROM checked"
    ),
    "checksum_split": with_lines(
        """SELECT file, rec_type, actual, status,
                  CASE WHEN CAST(substr(file, 9) AS INTEGER) % 4 <> 2 THEN CAST(declared AS BIGINT) END AS declared
           FROM checked"""
    ),
    "checksum_route": with_lines(
        "SELECT r.file, r.rec_type, r.line, c.status FROM recs r JOIN checked c USING (file, rec_type)"
    ),
    "hour_partition": """
        SELECT CAST(ts AS DATE) AS day, strftime(ts, '%Y/%m/%d/%H') AS hour, count(*) AS n
        FROM events GROUP BY ALL""",
    "null_split": """
        SELECT CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 THEN 'bad' ELSE 'good' END AS status,
               '9005' AS rec_type, '9005' AS _c0,
               CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS _c1,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS _c2
        FROM orders""",
}
