"""Inputs of the queries, derived from the given tables.

The extract is the union of three record types: 9000 from customer, 9005 from
orders, 9006 from lineitem. Records are dealt over extracts by their keys; an
extract holds about a million rows. Footers are made wrong on purpose, by the
extract's number modulo 4: 0 is right, 1 declares one 9005 too many, 2 has a
malformed total, 3 leaves 9000 out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import new_folder
from tallyfold.sources.readers import read_lines

KEYS_PER_STEP = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def data_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(extract, rec_type, value) of the data lines."""

    def typed(name: str, rec_type: str, deal, *fields: str) -> DataFrame:
        text = lambda f: F.date_format(f, "yyyyMMdd") if f.endswith("date") else F.col(f).cast("string")
        line = F.concat_ws("|", F.lit(rec_type), *[text(f) for f in fields])
        return table(spark, sf_dir, name).select(
            (4 * F.floor(deal / KEYS_PER_STEP) + deal % 4).cast("int").alias("extract"),
            F.lit(rec_type).alias("rec_type"),
            line.alias("value"),
        )

    parts = [
        typed("customer", "9000", F.col("c_custkey"), "c_custkey", "c_name", "c_mktsegment"),
        typed("orders", "9005", F.col("o_orderkey"), "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate"),
        typed(
            "lineitem",
            "9006",
            F.col("l_orderkey") + F.col("l_linenumber"),
            "l_orderkey",
            "l_linenumber",
            "l_returnflag",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(extract, value) with header, short lines and footer."""
    data = data_lines(spark, sf_dir)
    count = lambda t: F.count_if(F.col("rec_type") == t)
    kind = F.col("extract") % 4
    totals = data.groupBy("extract").agg(count("9000").alias("a"), count("9005").alias("b"), count("9006").alias("c"))
    control = totals.select(
        "extract",
        F.explode(
            F.array(
                F.concat(F.lit("H|EXTRACT|"), F.col("extract").cast("string")),
                F.lit("9005"),
                F.lit(""),
                F.concat_ws(
                    "|",
                    F.lit("T"),
                    F.when(kind != 3, F.concat(F.lit("9000~"), "a")),
                    F.concat(F.lit("9005~"), F.when(kind == 1, F.col("b") + 1).otherwise(F.col("b"))),
                    F.concat(F.lit("9006~"), F.when(kind == 2, F.lit("x")).otherwise(F.col("c").cast("string"))),
                ),
            )
        ).alias("value"),
    )
    return data.select("extract", "value").unionByName(control)


def extract_name(extract):
    return F.concat(F.lit("extract_"), extract.cast("string"))


_LANDED: dict[tuple[str, str], str] = {}


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The lines as text, a folder per extract. Written once per session.

    Rebalancing by extract gives each about one file of ordinary size and splits an
    extract that is larger than that.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _LANDED:
        path = new_folder(spark, "landing")
        rows = all_lines(spark, sf_dir).select(extract_name(F.col("extract")).alias("file"), "value")
        rows.hint("rebalance", "file").write.partitionBy("file").text(path)
        _LANDED[known] = path
    return _LANDED[known]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value) read back from the landing text, named by extract."""
    return read_lines(spark, landing(spark, sf_dir), folder="file")


# The same inputs in SQL.
LINES_SQL = """
data AS (
  SELECT 4 * (c_custkey // 1000000) + c_custkey % 4 AS extract, '9000' AS rec_type, CAST(c_custkey AS VARCHAR) AS k,
         concat_ws('|', '9000', c_custkey, c_name, c_mktsegment) AS line FROM customer
  UNION ALL
  SELECT 4 * (o_orderkey // 1000000) + o_orderkey % 4, '9005', CAST(o_orderkey AS VARCHAR),
         concat_ws('|', '9005', o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y%m%d')) FROM orders
  UNION ALL
  SELECT 4 * ((l_orderkey + l_linenumber) // 1000000) + (l_orderkey + l_linenumber) % 4, '9006',
         CAST(l_orderkey AS VARCHAR), concat_ws('|', '9006', l_orderkey, l_linenumber, l_returnflag) FROM lineitem
),
recs AS (SELECT 'extract_' || extract AS file, extract, rec_type, k, line FROM data),
counts AS (SELECT file, extract, rec_type, count(*) AS n FROM recs GROUP BY ALL),
totals AS (
  SELECT file, extract, rec_type,
         CASE WHEN extract % 4 = 1 AND rec_type = '9005' THEN n + 1
              WHEN extract % 4 = 2 AND rec_type = '9006' THEN NULL ELSE n END AS declared
  FROM counts WHERE NOT (extract % 4 = 3 AND rec_type = '9000')
),
checked AS (
  SELECT c.file, c.rec_type, c.n AS actual, coalesce(t.declared, 0) AS declared,
         CASE WHEN c.extract % 4 <> 2 AND c.n = coalesce(t.declared, 0) THEN 'pass' ELSE 'fail' END AS status
  FROM counts c LEFT JOIN totals t USING (file, rec_type)
),
landed AS (
  SELECT file, line AS value FROM recs
  UNION ALL SELECT DISTINCT file, 'H|EXTRACT|' || extract FROM recs
  UNION ALL SELECT DISTINCT file, '9005' FROM recs
  UNION ALL SELECT DISTINCT file, '' FROM recs
  UNION ALL
  SELECT file, concat_ws('|', 'T',
           CASE WHEN extract % 4 <> 3 THEN '9000~' || coalesce(max(n) FILTER (rec_type = '9000'), 0) END,
           '9005~' || (coalesce(max(n) FILTER (rec_type = '9005'), 0) + CASE WHEN extract % 4 = 1 THEN 1 ELSE 0 END),
           '9006~' || CASE WHEN extract % 4 = 2 THEN 'x'
                      ELSE CAST(coalesce(max(n) FILTER (rec_type = '9006'), 0) AS VARCHAR) END)
  FROM counts GROUP BY file, extract
)
"""


def with_lines(sql: str) -> str:
    return f"WITH {LINES_SQL} {sql}"
