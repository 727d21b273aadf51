"""Typed reads, column steps, and the record check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import config as C
from tallyfold.operators import columns, quality
from tallyfold.session import new_folder
from tallyfold.sources import readers, sinks
from workload.views import table

# ---- pipe-separated text ---------------------------------------------------------


def _as_text(df: DataFrame, name: str, *cells) -> str:
    path = new_folder(df.sparkSession, name)
    df.select(F.concat_ws("|", *cells).alias("value")).write.text(path)
    return path


def _part_text(spark: SparkSession, sf_dir: str) -> str:
    part = table(spark, sf_dir, "part")
    return _as_text(part, "part_text", F.col("p_partkey").cast("string"), "p_brand", F.col("p_size").cast("string"))


def pipe_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_untyped(spark, _part_text(spark, sf_dir))


def pipe_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_inferred(spark, _part_text(spark, sf_dir))


def pipe_fixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    total = F.when(F.col("o_orderkey") % 5 == 0, F.lit("n/a")).otherwise((F.col("o_orderkey") % 1000).cast("string"))
    path = _as_text(orders, "orders_text", F.lit("9005"), F.col("o_orderkey").cast("string"), "o_orderpriority", total)
    return readers.read_fixed(spark, path)


def ragged_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two, three and four fields, cut to three columns."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    line = F.concat_ws(
        "|",
        key.cast("string"),
        F.col("o_orderstatus"),
        F.when(key % 3 > 0, F.col("o_orderpriority")),
        F.when(key % 3 > 1, F.lit("extra")),
    )
    return readers.split_ragged(orders.select(line.alias("value")), 3)


PART_SCHEMA = {
    "part": {
        "columns": [
            {"name": "p_partkey", "type": "integer"},
            {"name": "p_name", "type": "string"},
            {"name": "p_retailprice", "type": "decimal(12,2)"},
            {"name": "p_size", "type": "integer"},
            {"name": "p_discount", "type": "double"},
            {"name": "p_since_DATE", "type": "date"},
        ]
    }
}


def _part_cells():
    key = F.col("p_partkey")
    return (
        key.cast("string"),
        F.concat(F.lit('"'), F.col("p_name"), F.lit("|"), F.col("p_brand"), F.lit('"')),
        F.when(key % 7 == 0, F.lit("free")).otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")),
        F.when(key % 9 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")),
        F.when(key % 2 == 0, F.lit("0.25")).otherwise(F.lit("half")),
        F.when(key % 5 == 0, F.lit("20240231")).otherwise(F.lit("20240229")),
    )


def typed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From files: quoted separators, unreadable numbers, impossible dates."""
    path = _as_text(table(spark, sf_dir, "part"), "typed_text", *_part_cells())
    typed = readers.read_typed(spark, path, C.schema_of(PART_SCHEMA, "part"))
    return columns.parse_dates(typed)


def typed_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from record lines, without files in between."""
    recs = table(spark, sf_dir, "part").select(F.concat_ws("|", *_part_cells()).alias("line"))
    return columns.parse_dates(readers.typed_records(recs, C.schema_of(PART_SCHEMA, "part")))


# ---- columns -----------------------------------------------------------------------


def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    odd = F.when(key % 13 == 0, F.lit("20241350")).when(key % 17 == 0, F.lit("soon")).otherwise(text)
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", odd.alias("ORDER_DATE"), text.alias("FULL_DATE_TXT"), text.alias("order_dt")
    )
    return columns.parse_dates(df)


def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit list instead of the name mark."""
    text = F.date_format("o_orderdate", "yyyyMMdd")
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("FULL_DATE_TXT"), text.alias("ORDER_DT"))
    return columns.parse_dates(df, ["ORDER_DT"])


AWKWARD = [" Part Key", "P-Name (mix)", "BRAND", "P Type", "Size(cm)", "retail-price"]


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.clean_names(table(spark, sf_dir, "part").toDF(*AWKWARD))


# ---- rules ---------------------------------------------------------------------------


def _judged(df: DataFrame, rule: C.Rule, *keep: str) -> DataFrame:
    rows = quality.row_outcomes(df, [rule])
    return rows.select(*keep, F.col(quality.RESULT).alias("result"))


def dq_column_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [C.column_count(6), C.column_count(7)]
    rows = quality.row_outcomes(table(spark, sf_dir, "orders"), rules)
    return quality.rule_outcomes(rows, rules, "orders").select("rule", "outcome", "n_rows")


def dq_values_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(table(spark, sf_dir, "orders"), C.values_eq("o_orderstatus", "O"), "o_orderkey")


def dq_values_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 4 > 0, F.col("o_orderstatus")).alias("ind"))
    return _judged(df, C.values_in("ind", ["O", "P"]), "o_orderkey")


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select("c_custkey", F.when(key % 6 > 0, F.col("c_mktsegment")).alias("segment"))
    return _judged(df, C.length_is("segment", 9), "c_custkey")


def dq_datatype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five texts per order, checked against five type names."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 10 == 0, F.lit("12e")).otherwise(F.concat(F.lit("-"), key.cast("string"), F.lit(".50"))).alias("num"),
        F.when(key % 10 == 1, F.lit("1.5")).otherwise(key.cast("string")).alias("whole"),
        F.when(key % 10 == 2, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("chars"),
        F.when(key % 10 == 3, F.lit("20230229")).when(key % 10 == 4, F.lit("2023022")).otherwise(day).alias("day"),
        F.when(key % 10 == 5, F.concat(day, F.lit("250000"))).otherwise(F.concat(day, F.lit("235959"))).alias("second"),
    )
    rules = [
        C.data_type("num", "NUMBER"),
        C.data_type("whole", "INTEGER"),
        C.data_type("chars", "CHAR"),
        C.data_type("day", "YYYYMMDD"),
        C.data_type("second", "YYYYMMDDHHMMSS"),
    ]
    rows = quality.row_outcomes(df, rules)
    return rows.select("o_orderkey", F.array_join(quality.ROWS_FAIL, "; ").alias("failed"))


def dq_is_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, an eighth of them missing, must not repeat."""
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 8 > 0, F.col("o_custkey")).alias("cust"))
    return _judged(df, C.is_unique("cust"), "o_orderkey")


def dq_is_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 8 > 0, F.col("o_custkey")).alias("cust"))
    return _judged(df, C.is_complete("cust"), "o_orderkey")


ORDER_RULES = C.rules_of(
    {
        "orders": "[ColumnCount = 7, ColumnValues 'REC' = '9005', ColumnLength 'REC' = 4, ColumnDataType 'CUST' = 'NUMBER', "
        "ColumnDataType 'DAY' = 'YYYYMMDD', IsUnique 'LINE', IsComplete 'CUST', IsComplete 'BRANCH', "
        "ColumnValues 'STATUS' in ['O', 'F'], IsUnique 'CUST']"
    },
    "orders",
)


def _orders_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order once, except that orders divisible by 19 share their line with the next."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("KEY"),
        F.when(key % 23 == 0, F.lit("900")).otherwise(F.lit("9005")).alias("REC"),
        F.when(key % 29 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("CUST"),
        F.when(key % 31 == 0, F.lit("20231301")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("DAY"),
        F.when(key % 19 == 1, key - 1).otherwise(key).cast("string").alias("LINE"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_orderpriority").alias("PRIORITY"),
    )


def row_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.row_outcomes(_orders_to_check(spark, sf_dir), ORDER_RULES)
    joined = lambda c, name: F.array_join(F.array_sort(c), "; ").alias(name)
    return rows.select(
        "KEY",
        joined(quality.ROWS_PASS, "passed"),
        joined(quality.ROWS_FAIL, "failed"),
        joined(quality.ROWS_SKIP, "skipped"),
        F.col(quality.RESULT).alias("result"),
    )


def rule_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.row_outcomes(_orders_to_check(spark, sf_dir), ORDER_RULES)
    return quality.rule_outcomes(rows, ORDER_RULES, "orders")


def row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "outcomes")
    sinks.write_outcomes(quality.row_outcomes(_orders_to_check(spark, sf_dir), ORDER_RULES[:5]), path)
    return spark.read.parquet(path).select("KEY", "status", F.col(quality.RESULT).alias("result"))


QUERIES = {
    f.__name__: f
    for f in (
        pipe_untyped,
        pipe_inferred,
        pipe_fixed_schema,
        ragged_width,
        typed_read,
        typed_from_lines,
        date_normalise,
        date_columns,
        clean_names,
        dq_column_count,
        dq_values_eq,
        dq_values_in,
        dq_length,
        dq_datatype,
        dq_is_unique,
        dq_is_complete,
        row_outcomes,
        rule_outcomes,
        row_split,
    )
}

_TYPED = """
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name || '|' || p_brand AS p_name,
           CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_retailprice AS DECIMAL(12, 2)) END AS p_retailprice,
           CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS p_size,
           CASE WHEN p_partkey % 2 = 0 THEN CAST(0.25 AS DOUBLE) END AS p_discount,
           CASE WHEN p_partkey % 5 <> 0 THEN DATE '2024-02-29' END AS "p_since_DATE"
    FROM part"""

_CHECKED = """
    WITH src AS (
      SELECT o_orderkey AS "KEY",
             CASE WHEN o_orderkey % 23 = 0 THEN '900' ELSE '9005' END AS rec,
             CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cust,
             o_orderkey % 31 <> 0 AS day_ok,
             CASE WHEN o_orderkey % 19 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS line,
             o_orderstatus AS status
      FROM orders
    ),
    judged AS (
      SELECT "KEY", [
        {t: 'ColumnValues "REC" = "9005"', ok: rec = '9005'},
        {t: 'ColumnLength "REC" = 4', ok: length(rec) = 4},
        {t: 'ColumnDataType "CUST" = "NUMBER"', ok: cust IS NOT NULL},
        {t: 'ColumnDataType "DAY" = "YYYYMMDD"', ok: day_ok},
        {t: 'IsUnique "LINE"', ok: count(*) OVER (PARTITION BY line) = 1},
        {t: 'IsComplete "CUST"', ok: cust IS NOT NULL},
        {t: 'ColumnValues "STATUS" in ["O", "F"]', ok: status IN ('O', 'F')},
        {t: 'IsUnique "CUST"', ok: count(*) OVER (PARTITION BY cust) = 1}
      ] AS r FROM src
    )
"""

ORACLE = {
    "pipe_untyped": """
        SELECT CAST(p_partkey AS VARCHAR) AS _c0, p_brand AS _c1, CAST(p_size AS VARCHAR) AS _c2 FROM part""",
    "pipe_inferred": "SELECT CAST(p_partkey AS INTEGER) AS _c0, p_brand AS _c1, p_size AS _c2 FROM part",
    "pipe_fixed_schema": """
        SELECT 9005 AS _c0, CAST(o_orderkey AS VARCHAR) AS _c1, o_orderpriority AS _c2,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 1000 AS INTEGER) END AS _c3 FROM orders""",
    "ragged_width": """
        SELECT CAST(o_orderkey AS VARCHAR) AS _c0, o_orderstatus AS _c1,
               CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS _c2,
               CAST(2 + o_orderkey % 3 AS INTEGER) AS n_fields FROM orders""",
    "typed_read": _TYPED,
    "typed_from_lines": _TYPED,
    "date_normalise": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS "ORDER_DATE",
               CAST(o_orderdate AS DATE) AS "FULL_DATE_TXT", strftime(o_orderdate, '%Y%m%d') AS order_dt FROM orders""",
    "date_columns": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS "FULL_DATE_TXT", CAST(o_orderdate AS DATE) AS "ORDER_DT"
        FROM orders""",
    "clean_names": """
        SELECT p_partkey AS part_key, p_name AS p_name_mix, p_brand AS brand, p_type, p_size AS sizecm,
               p_retailprice AS retail_price FROM part""",
    "dq_column_count": """
        SELECT 'ColumnCount = ' || w AS rule, CASE WHEN w = 6 THEN 'Passed' ELSE 'Failed' END AS outcome,
               (SELECT count(*) FROM orders) AS n_rows FROM (VALUES (6), (7)) t(w)""",
    "dq_values_eq": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Passed' ELSE 'Failed' END AS result FROM orders""",
    "dq_values_in": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 AND o_orderstatus IN ('O', 'P') THEN 'Passed' ELSE 'Failed' END
               AS result FROM orders""",
    "dq_length": """
        SELECT c_custkey, CASE WHEN c_custkey % 6 > 0 AND length(c_mktsegment) = 9 THEN 'Passed' ELSE 'Failed' END
               AS result FROM customer""",
    "dq_datatype": """
        SELECT o_orderkey, CASE o_orderkey % 10
                 WHEN 0 THEN 'ColumnDataType "num" = "NUMBER"' WHEN 1 THEN 'ColumnDataType "whole" = "INTEGER"'
                 WHEN 2 THEN 'ColumnDataType "chars" = "CHAR"' WHEN 3 THEN 'ColumnDataType "day" = "YYYYMMDD"'
                 WHEN 4 THEN 'ColumnDataType "day" = "YYYYMMDD"'
                 WHEN 5 THEN 'ColumnDataType "second" = "YYYYMMDDHHMMSS"' ELSE '' END AS failed FROM orders""",
    "dq_is_unique": """
        SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY CASE WHEN o_orderkey % 8 > 0 THEN o_custkey END) = 1
               THEN 'Passed' ELSE 'Failed' END AS result FROM orders""",
    "dq_is_complete": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 8 > 0 THEN 'Passed' ELSE 'Failed' END AS result FROM orders""",
    "row_outcomes": _CHECKED
    + """
        SELECT "KEY",
               array_to_string(list_sort([x.t FOR x IN r IF x.ok]), '; ') AS passed,
               array_to_string(list_sort([x.t FOR x IN r IF NOT x.ok]), '; ') AS failed,
               'ColumnCount = 7; IsComplete "BRANCH"' AS skipped,
               CASE WHEN len([x.t FOR x IN r IF NOT x.ok]) = 0 THEN 'Passed' ELSE 'Failed' END AS result
        FROM judged""",
    "rule_outcomes": _CHECKED
    + """
        , totals AS (
          SELECT x.t AS rule, count(*) AS n_rows, count(*) FILTER (NOT x.ok) AS n_failed
          FROM (SELECT unnest(r) AS x FROM judged) GROUP BY x.t
        )
        SELECT 'orders' AS rec_type, rule, CASE WHEN n_failed = 0 THEN 'Passed' ELSE 'Failed' END AS outcome,
               CASE WHEN n_failed > 0 THEN n_failed || ' rows do not hold' END AS reason, n_rows, n_failed FROM totals
        UNION ALL
        SELECT 'orders', 'ColumnCount = 7', 'Passed', NULL, count(*), 0 FROM orders
        UNION ALL
        SELECT 'orders', 'IsComplete "BRANCH"', 'Failed', 'column not found', count(*), 0 FROM orders""",
    "row_split": """
        SELECT o_orderkey AS "KEY",
               CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN 'fail' ELSE 'pass' END AS status,
               CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN 'Failed' ELSE 'Passed' END AS result
        FROM orders""",
}
