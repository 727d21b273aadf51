"""Upserts, slowly changing histories, and pivots."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.config import HistoryConfig, TransposeConfig
from tallyfold.operators import history as H
from tallyfold.operators.transpose import transpose as pivot
from tallyfold.session import new_folder
from tallyfold.sources import buckets, catalog, sinks, tables
from workload.views import table

DAY1, DAY2 = "2024-02-01", "2024-03-01"

# ---- append-upsert ------------------------------------------------------------------

ORDERS = HistoryConfig("orders", ("order_key",), "batch_no")


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of orders into a stored history: the second repeats a third of
    the first on the same day, and adds the rest on the next."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        key.alias("Order Key"),
        F.col("o_orderstatus").alias("STATUS"),
        F.lit("x").alias("DataQualityEvaluationResult"),
    )
    key = F.col("`Order Key`")
    path = new_folder(spark, "append_history")
    first = orders.where(key % 2 == 0).withColumn("batch-no", F.lit(1))
    again = orders.where(key % 3 == 0).withColumn("batch-no", F.lit(2)).withColumn("STATUS", F.lit("again"))
    rest = orders.where(key % 2 == 1).withColumn("batch-no", F.lit(3))
    for batch, day in ((first, DAY1), (again, DAY1), (rest, DAY2)):
        tables.upsert_append(spark, path, H.history_rows(batch, day), ORDERS)
    return tables.read_append(spark, path)


def append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that comes with the second day's batch is null for the rows of the first."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), F.lit(1).alias("batch_no"))
    path, even = new_folder(spark, "append_column"), F.col("order_key") % 2 == 0
    tables.upsert_append(spark, path, H.history_rows(orders.where(even), DAY1), ORDERS)
    tables.upsert_append(spark, path, H.history_rows(orders.where(~even).withColumn("note", F.lit("new")), DAY2), ORDERS)
    return tables.read_append(spark, path).select("order_key", "batch_no", "note", "dt")


EVENTS = ["event_id", "ts", "user_id", "event_type", "value"]
NEWEST = ["ts", "event_id"]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENTS).withColumn("dt", F.col("ts").cast("date"))


def _result(df: DataFrame) -> DataFrame:
    return df.select("dt", "user_id", "event_id", "event_type", "value")


def upsert_batch_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result(H.newest(_events(spark, sf_dir), ["user_id"], NEWEST))


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Odd events incoming, the others stored; users divisible by 5 have all of theirs stored."""
    events = _events(spark, sf_dir)
    incoming = (F.col("event_id") % 2 == 1) & (F.col("user_id") % 5 > 0)
    return events.where(~incoming), events.where(incoming)


def _upserted(spark: SparkSession, sf_dir: str, scope: str, compare: bool = False) -> DataFrame:
    old, new = _two_loads(spark, sf_dir)
    stored = H.upsert(None, old, ["user_id"], NEWEST, scope)
    return _result(H.upsert(stored, new, ["user_id"], NEWEST, scope, compare))


def upsert_partition_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "partition")


def upsert_table_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "table")


def upsert_compare_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, "table", True)


# ---- slowly changing rows -----------------------------------------------------------

CUSTOMERS = HistoryConfig("customer", ("c_custkey",), "batch_date", delete_indicator="ind")
SEGMENTS = HistoryConfig("customer", ("c_custkey",), "batch_date", joining_key=("c_nationkey",), delete_indicator="ind")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; those divisible by 30 arrive deleted."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.col("c_mktsegment").alias("segment"),
        F.lit("2024-01-31").alias("batch_date"),
        F.when(key % 30 == 0, F.lit("D")).when(key % 3 == 0, F.lit("A")).alias("ind"),
    )


def _delta(spark: SparkSession, sf_dir: str, new: str = "20240229", old: str = "20240215") -> DataFrame:
    """Every tenth customer changed, every twentieth of them deleted, new ones from
    every fiftieth; each changed one also comes in an older version."""
    customer, key = table(spark, sf_dir, "customer"), F.col("c_custkey")
    changed = customer.where(key % 10 == 0)
    row = lambda df, k, day, segment, ind: df.select(
        k.alias("c_custkey"), "c_nationkey", segment.alias("segment"), F.lit(day).alias("batch_date"), ind.alias("ind")
    )
    ind = F.when(key % 20 == 0, F.lit("D")).otherwise(F.lit("C"))
    fresh = row(changed, key, new, F.lit("CHANGED"), ind)
    stale = row(changed, key, old, F.lit("STALE"), F.lit("C"))
    added = row(customer.where(key % 50 == 1), key + 1_000_000_000_000, new, F.col("c_mktsegment"), F.lit("A"))
    return fresh.unionByName(stale).unionByName(added)


SCD2 = ["c_custkey", "segment", "record_start_date", "record_end_date", "current_record_flag", "delete_flag", "dt"]


def scd2_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.new_rows(_base(spark, sf_dir), CUSTOMERS, DAY1).select(*SCD2)


def scd2_delete_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    return base.select("c_custkey", H.delete_flag(base, "ind").alias("flag"), H.delete_flag(base, None).alias("none"))


def scd2_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = H.current_rows(H.new_rows(_base(spark, sf_dir), CUSTOMERS, DAY1))
    return H.close_rows(current, _delta(spark, sf_dir), CUSTOMERS, DAY2).select(*SCD2)


def scd2_close_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing by a key that many rows share, ending the day before."""
    current = H.current_rows(H.new_rows(_base(spark, sf_dir), SEGMENTS, DAY1))
    batch = _delta(spark, sf_dir).where(F.col("c_nationkey") < 12)
    return H.close_rows(current, batch, SEGMENTS, DAY2, "day_before").select(*SCD2)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = H.merge(None, _base(spark, sf_dir), CUSTOMERS, DAY1)
    return H.merge(history, _delta(spark, sf_dir), CUSTOMERS, DAY2).select(*SCD2)


def scd2_merge_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = H.merge(None, _base(spark, sf_dir), CUSTOMERS, DAY1)
    return H.merge(history, _delta(spark, sf_dir), CUSTOMERS, DAY2, strict_reference=True).select(*SCD2)


def scd2_load_no_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = H.merge(None, _base(spark, sf_dir), CUSTOMERS, DAY1)
    return H.load_without_closing(history, _delta(spark, sf_dir), CUSTOMERS, DAY2).select(*SCD2)


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """Both batches committed to a stored history, the second one twice."""
    path = new_folder(spark, "scd2")
    tables.commit_history(spark, path, _base(spark, sf_dir), CUSTOMERS, DAY1)
    tables.commit_history(spark, path, _delta(spark, sf_dir), CUSTOMERS, DAY2)
    tables.commit_history(spark, path, _delta(spark, sf_dir), CUSTOMERS, DAY2)
    tables.expire_versions(spark, path, keep=2)
    return path


def history_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_history(spark, _stored(spark, sf_dir)).select(*SCD2)


def history_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history as the first batch left it; a version that has expired is refused."""
    path = new_folder(spark, "scd2_as_of")
    for batch, day in ((_base(spark, sf_dir), DAY1), (_delta(spark, sf_dir), DAY2)):
        tables.commit_history(spark, path, batch, CUSTOMERS, day)
    return tables.read_history(spark, path, as_of=0).select(*SCD2)


def history_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches without rows, before the first one and between two, are no commits."""
    path = new_folder(spark, "scd2_empty")
    none = _base(spark, sf_dir).where("c_custkey is null")
    for batch, day in ((none, DAY1), (_base(spark, sf_dir), DAY1), (none, DAY2), (_delta(spark, sf_dir), DAY2)):
        tables.commit_history(spark, path, batch, CUSTOMERS, day)
    return tables.read_history(spark, path).select(*SCD2)


def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch comes first; the base, older than all of it, finds its place behind it."""
    path = new_folder(spark, "scd2_late")
    for batch, day in ((_delta(spark, sf_dir), DAY1), (_base(spark, sf_dir), DAY2)):
        tables.commit_history(spark, path, batch, CUSTOMERS, day, out_of_order=True)
    return tables.read_history(spark, path).select(*SCD2)


def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Halves of orders and of customers, each written by two writers at once to one table."""
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    orders = orders.select(key.alias("order_key"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("batch_no"))
    customers = _base(spark, sf_dir)
    appended, valid = new_folder(spark, "writers_append"), new_folder(spark, "writers_valid")

    def write(half: int) -> None:
        mine = H.history_rows(orders.where(F.col("order_key") % 2 == half), DAY1)
        tables.upsert_append(spark, appended, mine, ORDERS)
        tables.commit_history(spark, valid, customers.where(F.col("c_custkey") % 2 == half), CUSTOMERS, DAY1)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, range(2)))
    rows = tables.read_append(spark, appended).select(F.lit("append").alias("style"), F.col("order_key").alias("key"), "status")
    customers = tables.read_history(spark, valid).where(F.col(H.CURRENT) == 1)
    return rows.unionByName(customers.select(F.lit("valid").alias("style"), F.col("c_custkey").alias("key"), F.col("segment").alias("status")))


BUCKETS = 16


def scd2_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history in hash buckets: all customers, then the changes, then those of one customer in a hundred."""
    path = new_folder(spark, "scd2_buckets")
    few = _delta(spark, sf_dir, "20240310", "20240305").where(F.col("c_custkey") % 100 == 0)
    buckets.commit(spark, path, _base(spark, sf_dir), CUSTOMERS, DAY1, n_buckets=BUCKETS)
    buckets.commit(spark, path, _delta(spark, sf_dir), CUSTOMERS, DAY2)
    buckets.commit(spark, path, few, CUSTOMERS, "2024-03-11")
    return buckets.read(spark, path).select(*SCD2)


def scd2_buckets_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed history as its first commit left it."""
    path = new_folder(spark, "scd2_buckets")
    buckets.commit(spark, path, _base(spark, sf_dir), CUSTOMERS, DAY1, n_buckets=BUCKETS)
    buckets.commit(spark, path, _delta(spark, sf_dir), CUSTOMERS, DAY2)
    return buckets.read(spark, path, as_of=0).select(*SCD2)


def catalog_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored history read by the name it was given."""
    path = _stored(spark, sf_dir)
    database, name = "tallyfold_histories", "customer_" + path[-12:]
    catalog.ensure_database(spark, database, new_folder(spark, "warehouse"))
    catalog.publish_history(spark, database, name, path)
    return catalog.read_table(spark, database, name).select(*SCD2)


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.current_rows(tables.read_open(spark, _stored(spark, sf_dir))).select("c_custkey", "segment", "record_start_date")


# ---- pivots ---------------------------------------------------------------------------


def _flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def transpose(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = TransposeConfig(("l_suppkey",), "l_returnflag", "n", ("l_suppkey", "l_returnflag", "n"), ("A", "N"))
    path = new_folder(spark, "wide")
    sinks.write_wide(pivot(_flag_counts(spark, sf_dir), cfg), path)
    return spark.read.parquet(path)


def transpose_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _flag_counts(spark, sf_dir).withColumn(
        "l_returnflag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    )
    cfg = TransposeConfig(("l_suppkey",), "l_returnflag", "n")
    return pivot(rows, cfg).withColumnRenamed("null", "other")


def transpose_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = TransposeConfig(
        ("user_id",),
        "event_type",
        "value",
        pivot_values=("click", "error", "purchase", "signup", "view"),
        order_by=("ts", "event_id"),
    )
    return pivot(table(spark, sf_dir, "events"), cfg)


QUERIES = {
    f.__name__: f
    for f in (
        history_append,
        append_new_column,
        upsert_batch_dedupe,
        upsert_partition_scope,
        upsert_table_scope,
        upsert_compare_stored,
        scd2_insert,
        scd2_delete_flag,
        scd2_close,
        scd2_close_by_group,
        scd2_merge,
        scd2_merge_strict,
        scd2_load_no_close,
        history_snapshot,
        history_as_of,
        history_empty_batch,
        scd2_late,
        two_writers,
        scd2_buckets,
        scd2_buckets_as_of,
        catalog_history,
        scd2_current,
        transpose,
        transpose_discovered,
        transpose_ordered,
    )
}


def _upsert_sql(keys: str, compare: bool = False) -> str:
    order = "ts DESC, event_id DESC" if compare else "incoming DESC, ts DESC, event_id DESC"
    return f"""
        SELECT CAST(ts AS DATE) AS dt, user_id, event_id, event_type, value
        FROM (SELECT *, event_id % 2 = 1 AND user_id % 5 > 0 AS incoming FROM events)
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


_SCD2 = """
    WITH base AS (
      SELECT c_custkey, c_nationkey, c_mktsegment AS segment, DATE '2024-01-31' AS record_start_date,
             DATE '9999-12-31' AS record_end_date, 1 AS current_record_flag,
             CASE WHEN c_custkey % 30 = 0 THEN 1 ELSE 0 END AS delete_flag, DATE '2024-02-01' AS dt FROM customer
    ),
    added AS (
      SELECT c_custkey, c_nationkey, 'CHANGED' AS segment, DATE '2024-02-29' AS record_start_date,
             DATE '9999-12-31' AS record_end_date, 1 AS current_record_flag,
             CASE WHEN c_custkey % 20 = 0 THEN 1 ELSE 0 END AS delete_flag, DATE '2024-03-01' AS dt
      FROM customer WHERE c_custkey % 10 = 0
      UNION ALL
      SELECT c_custkey + 1000000000000, c_nationkey, c_mktsegment, DATE '2024-02-29', DATE '9999-12-31', 1, 0,
             DATE '2024-03-01' FROM customer WHERE c_custkey % 50 = 1
    )
"""
_COLS = "c_custkey, segment, record_start_date, record_end_date, current_record_flag, delete_flag, dt"
_CLOSED = """c_custkey, segment, record_start_date, DATE '2024-03-01' AS record_end_date, 0 AS current_record_flag,
             delete_flag, DATE '2024-03-01' AS dt"""
_MERGED = f"""
    SELECT {_COLS} FROM added UNION ALL
    SELECT {_CLOSED} FROM base WHERE c_custkey % 10 = 0 UNION ALL
    SELECT {_COLS} FROM base WHERE c_custkey % 10 <> 0"""

ORACLE = {
    "history_append": """
        SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 3 = 0 THEN 'again' ELSE o_orderstatus END AS status,
               CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS batch_no, DATE '2024-02-01' AS dt
        FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
        UNION ALL
        SELECT o_orderkey, o_orderstatus, 3, DATE '2024-03-01' FROM orders WHERE o_orderkey % 2 = 1""",
    "upsert_batch_dedupe": """
        SELECT CAST(ts AS DATE) AS dt, user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_partition_scope": _upsert_sql("CAST(ts AS DATE), user_id"),
    "upsert_table_scope": _upsert_sql("user_id"),
    "upsert_compare_stored": _upsert_sql("user_id", compare=True),
    "scd2_insert": _SCD2 + f"SELECT {_COLS} FROM base",
    "scd2_delete_flag": """
        SELECT c_custkey, CASE WHEN c_custkey % 30 = 0 THEN 1 ELSE 0 END AS flag, 0 AS none FROM customer""",
    "scd2_close": _SCD2 + f"SELECT {_CLOSED} FROM base WHERE c_custkey % 10 = 0 AND delete_flag = 0",
    "scd2_close_by_group": _SCD2
    + """SELECT c_custkey, segment, record_start_date, DATE '2024-02-29' AS record_end_date, 0 AS current_record_flag,
                delete_flag, DATE '2024-03-01' AS dt
         FROM base WHERE delete_flag = 0 AND c_nationkey < 12 AND c_nationkey IN (SELECT c_nationkey FROM added)""",
    "scd2_merge": _SCD2 + _MERGED,
    "scd2_merge_strict": _SCD2
    + f"""
        SELECT {_COLS} FROM added UNION ALL
        SELECT {_CLOSED} FROM base WHERE c_custkey % 10 = 0 AND delete_flag = 0 UNION ALL
        SELECT {_COLS} FROM base WHERE c_custkey % 10 <> 0 OR delete_flag = 1""",
    "scd2_load_no_close": _SCD2 + f"SELECT {_COLS} FROM base UNION ALL SELECT {_COLS} FROM added",
    "history_snapshot": _SCD2 + _MERGED,
    "history_as_of": _SCD2 + f"SELECT {_COLS} FROM base",
    "history_empty_batch": _SCD2 + _MERGED,
    "append_new_column": """
        SELECT o_orderkey AS order_key, 1 AS batch_no, CASE WHEN o_orderkey % 2 = 1 THEN 'new' END AS note,
               CASE WHEN o_orderkey % 2 = 0 THEN DATE '2024-02-01' ELSE DATE '2024-03-01' END AS dt FROM orders""",
    "scd2_late": _SCD2
    + """, placed AS (
        SELECT c_custkey, segment, record_start_date, delete_flag, DATE '2024-03-01' AS dt FROM base UNION ALL
        SELECT c_custkey, segment, record_start_date, delete_flag, DATE '2024-02-01' FROM added UNION ALL
        SELECT c_custkey, 'STALE', DATE '2024-02-15', 0, DATE '2024-02-01' FROM base WHERE c_custkey % 10 = 0
    )
    SELECT c_custkey, segment, record_start_date,
           coalesce(lead(record_start_date) OVER (PARTITION BY c_custkey ORDER BY record_start_date), DATE '9999-12-31')
               AS record_end_date,
           CASE WHEN lead(record_start_date) OVER (PARTITION BY c_custkey ORDER BY record_start_date) IS NULL THEN 1 ELSE 0 END
               AS current_record_flag, delete_flag, dt
    FROM placed""",
    "two_writers": """
        SELECT 'append' AS style, o_orderkey AS key, o_orderstatus AS status FROM orders
        UNION ALL SELECT 'valid', c_custkey, c_mktsegment FROM customer""",
    "scd2_buckets": _SCD2
    + f"""
        SELECT {_COLS} FROM added WHERE c_custkey % 100 <> 0 OR segment <> 'CHANGED' UNION ALL
        SELECT {_CLOSED} FROM base WHERE c_custkey % 10 = 0 UNION ALL
        SELECT {_COLS} FROM base WHERE c_custkey % 10 <> 0 UNION ALL
        SELECT c_custkey, segment, record_start_date, DATE '2024-03-11', 0, delete_flag, DATE '2024-03-11'
        FROM added WHERE c_custkey % 100 = 0 AND segment = 'CHANGED' UNION ALL
        SELECT c_custkey, segment, DATE '2024-03-10', DATE '9999-12-31', 1, delete_flag, DATE '2024-03-11'
        FROM added WHERE c_custkey % 100 = 0 AND segment = 'CHANGED'""",
    "scd2_buckets_as_of": _SCD2 + f"SELECT {_COLS} FROM base",
    "catalog_history": _SCD2 + _MERGED,
    "scd2_current": _SCD2
    + """
        SELECT c_custkey, segment, record_start_date FROM base WHERE c_custkey % 10 <> 0 AND delete_flag = 0
        UNION ALL SELECT c_custkey, segment, record_start_date FROM added WHERE delete_flag = 0""",
    "transpose": """
        SELECT l_suppkey, nullif(count(*) FILTER (l_returnflag = 'A'), 0) AS "A",
               nullif(count(*) FILTER (l_returnflag = 'N'), 0) AS "N" FROM lineitem GROUP BY l_suppkey""",
    "transpose_discovered": """
        SELECT l_suppkey, nullif(count(*) FILTER (l_returnflag = 'A'), 0) AS "A",
               nullif(count(*) FILTER (l_returnflag = 'N'), 0) AS "N",
               nullif(count(*) FILTER (l_returnflag = 'R'), 0) AS other FROM lineitem GROUP BY l_suppkey""",
    "transpose_ordered": """
        SELECT user_id,
               arg_min(value, (ts, event_id)) FILTER (event_type = 'click') AS click,
               arg_min(value, (ts, event_id)) FILTER (event_type = 'error') AS error,
               arg_min(value, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase,
               arg_min(value, (ts, event_id)) FILTER (event_type = 'signup') AS signup,
               arg_min(value, (ts, event_id)) FILTER (event_type = 'view') AS view
        FROM events GROUP BY user_id""",
}
