"""Scalar functions, absent input, tables by name, streams, and the whole batch."""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import config as C
from tallyfold.functions import text as X
from tallyfold.operators import extract
from tallyfold.operators import history as H
from tallyfold.plans import batch, ledger
from tallyfold.session import new_folder
from tallyfold.sources import catalog, readers, sinks, tables
from tallyfold.streaming import arrivals, assembly, deliveries
from workload.views import KEYS_PER_STEP, all_lines, extract_name, landing, lines, table, with_lines

RUN_DATE = "2024-09-02"

# ---- scalar functions ------------------------------------------------------------------


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    line = F.concat_ws("|", F.lit("9005"), key, F.lit(""), F.col("o_orderpriority"))
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey") % 24)
    pair = F.concat_ws("~", F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 3 > 0, key).otherwise(F.lit("1.5")))
    sides = F.split(pair, "~")
    url = F.concat(F.lit("s3://landing-zone/day/"), key, F.lit("/file.txt"))
    day_text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("19990231")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.size(X.fields(line)).alias("n_fields"),
        X.record_type(line).alias("first_part"),
        X.first_field(X.fields(line)).alias("first_field"),
        X.last_field(X.fields(line)).alias("last_field"),
        F.get(sides, F.lit(0)).alias("pair_key"),
        X.whole_number(F.get(sides, F.lit(1))).alias("pair_count"),
        X.strip(F.concat(F.lit(" \t"), F.col("o_orderpriority"), F.lit("\r "))).alias("stripped"),
        F.concat(F.lit("rec_type_"), key, F.lit(".txt")).alias("file_name"),
        X.date_or_null(day_text).alias("day"),
        X.batch_day(day_text).alias("batch_day"),
        F.date_sub(F.col("o_orderdate").cast("date"), 1).alias("day_before"),
        F.lit(H.OPEN_END).alias("open_end"),
        H.day(RUN_DATE).alias("run_day"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("flag"),
        (F.col("o_orderstatus").isNotNull() & (F.col("o_orderstatus") == "O")).alias("is_open"),
        X.day_folder(ts).alias("day_folder"),
        X.hour_folder(ts).alias("hour_folder"),
        X.base_name(url).alias("base_name"),
        X.folder_name(url).alias("folder"),
        X.url_bucket(url).alias("bucket"),
        X.url_key(url).alias("object_key"),
        X.arrival_message(X.base_name(url), X.url_bucket(url), F.date_format(ts, "yyyy-MM-dd")).alias("message"),
    )


# ---- absent input, tables by name ----------------------------------------------------------


def missing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading policy over folders of which some are absent."""
    schema = table(spark, sf_dir, "orders").schema
    folders = [f"{sf_dir}/orders.parquet", f"{sf_dir}/orders_absent.parquet", f"{sf_dir}/orders_absent/day=1"]
    found = [
        readers.read_parquet(spark, f, schema, missing="skip").withColumn("folder", F.lit(i)) for i, f in enumerate(folders)
    ]
    present = [readers.table_exists(spark, f) for f in folders]
    return reduce(DataFrame.unionByName, found).select("o_orderkey", "folder", F.lit(sum(present)).alias("n_present"))


def _database(spark: SparkSession) -> str:
    name = "tallyfold_checks"
    catalog.ensure_database(spark, name, new_folder(spark, "warehouse"))
    return name


def _customer_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Customers stored by segment and registered under a name."""
    path = new_folder(spark, "customer")
    table(spark, sf_dir, "customer").write.partitionBy("c_mktsegment").parquet(path)
    db = _database(spark)
    name = "customer_" + path[-12:]
    catalog.register(spark, db, name, path, partitioned=True)
    return db, name


def catalog_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of unknown layout, registered with discovered column types."""
    path = new_folder(spark, "orders_text")
    cells = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")]
    table(spark, sf_dir, "orders").select(F.concat_ws("|", *cells).alias("value")).write.text(path)
    db = _database(spark)
    name = "orders_" + path[-12:]
    catalog.discover(spark, db, name, path)
    return catalog.read_table(spark, db, name)


def catalog_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layouts below one folder, found twice: the second time columns got wider and partitions were added."""
    root, db = new_folder(spark, "crawled"), "tallyfold_crawl_" + uuid.uuid4().hex[:8]
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    text = lambda c: F.col(c).cast("string")
    changes = []
    for half in range(2):
        key = text("o_orderkey") if half == 0 else F.concat(text("o_orderkey"), F.lit("000000000"))
        price = text("o_custkey") if half == 0 else F.concat(text("o_custkey"), F.lit(".5"))
        lines = orders.where(F.col("o_orderkey") % 2 == half)
        lines.select(F.concat_ws("|", key, price, F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderstatus")).write.mode("append").text(f"{root}/daily/orders")
        mine = customers.where((F.col("c_mktsegment") < "C") == (half == 0)).select("c_custkey", "c_name", "c_mktsegment")
        mine.write.mode("append").partitionBy("c_mktsegment").parquet(f"{root}/customers")
        if half == 0:
            table(spark, sf_dir, "supplier").select(F.concat_ws("|", text("s_suppkey"), "s_name")).write.text(f"{root}/suppliers")
        changes.append(catalog.crawl(spark, db, root).withColumn("round", F.lit(half)))
    found = [
        catalog.read_table(spark, db, t).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t).alias("table"), F.lit(", ".join(k for _, k in catalog.read_table(spark, db, t).dtypes)).alias("types"), "n_rows"
        )
        for t in ("daily_orders", "customers", "suppliers")
    ]
    report = reduce(DataFrame.unionByName, changes).groupBy("table").agg(F.max_by("change", "round").alias("change"))
    return reduce(DataFrame.unionByName, found).join(report, "table")


def catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.read_table(spark, *_customer_table(spark, sf_dir))


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, name = _customer_table(spark, sf_dir)
    return catalog.query(
        spark,
        f"""SELECT n.n_name, c.c_mktsegment, count(*) AS n FROM `{db}`.`{name}` c
            JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name, c.c_mktsegment""",
        nation=table(spark, sf_dir, "nation"),
    )


# ---- streams -----------------------------------------------------------------------------------


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts checked and routed as they arrive."""
    out = new_folder(spark, "ingest")
    stream = arrivals.line_stream(spark, landing(spark, sf_dir))
    _finish(arrivals.ingest(stream, f"{out}/data", f"{out}/checkpoint", folder="file"))
    return sinks.read_routed(spark, f"{out}/data/records").select("file", "rec_type", "line", "status")


def _touch(spark: SparkSession, path: str, seconds: int) -> None:
    """Let the files of a folder have arrived so many seconds from now."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(p):
        fs.setTimes(status.getPath(), int(1000 * (time.time() + seconds)), -1)


def _marker(spark: SparkSession, landed: str, name: str, seconds: int) -> None:
    """An extract of one header line that arrives at another time."""
    spark.createDataFrame([("H|" + name,)], "value string").coalesce(1).write.text(f"{landed}/file={name}")
    _touch(spark, f"{landed}/file={name}", seconds)


def stream_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts in four parts or more, taken six files at a time: checks, and records routed under them.

    Of a folder with many files a sixteenth is taken at a time, so that a longer
    backlog makes micro-batches larger and not more. Complete ones are judged on arrival, the others when a file comes two days
    later, after the stream was started again.
    """
    root = new_folder(spark, "assembly")
    parts = all_lines(spark, sf_dir).select(
        extract_name(F.col("extract")).alias("file"), F.pmod(F.xxhash64("value"), F.lit(4)).alias("part"), "value"
    )
    parts.hint("rebalance", "file", "part").write.partitionBy("file", "part").text(f"{root}/landing")
    at_once = max(6, readers.file_names(spark, f"{root}/landing").count() // 16)
    for again in (False, True):
        if again:
            _marker(spark, f"{root}/landing", "later", 2 * 86400)
        stream = assembly.part_stream(spark, f"{root}/landing", "file", at_once)
        _finish(assembly.assemble(stream, f"{root}/out", f"{root}/checkpoint", "file", 3600))
    checks = spark.read.schema(assembly.CHECKS).parquet(f"{root}/out/checks")
    routed = sinks.read_routed(spark, f"{root}/out/records").groupBy("file", "rec_type", "status")
    routed = routed.agg(F.count(F.lit(1)).alias("routed"))
    cells = ("file", "rec_type", "actual", "declared", "status", "reason", "routed")
    return checks.join(routed, ["file", "rec_type", "status"], "left").select(*cells)


def stream_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts delivered twice under two names, one of them late: what became of each file, and the lines taken."""
    root, within = new_folder(spark, "deliveries"), "1 day"
    landed, ledger = f"{root}/landing", f"{root}/ledger"
    all_lines(spark, sf_dir).select(extract_name(F.col("extract")).alias("file"), "value").hint("rebalance", "file").write.partitionBy(
        "file"
    ).text(landed)
    _finish(deliveries.log_deliveries(spark, landed, ledger, f"{root}/cp_ledger", within))
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(landed).getFileSystem(spark._jsc.hadoopConfiguration())
    again = [s.getPath().getName() for s in fs.listStatus(p(landed)) if s.getPath().getName().startswith("file=")]
    copied = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    copy = lambda name: copied(fs, p(f"{landed}/{name}"), fs, p(f"{landed}/{name}_again"), False, spark._jsc.hadoopConfiguration())
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(copy, again))
    _marker(spark, landed, "late", -3 * 86400)
    _finish(deliveries.log_deliveries(spark, landed, ledger, f"{root}/cp_ledger", within))
    _finish(deliveries.ingest_ledger(spark, ledger, f"{root}/out", f"{root}/cp_out", "file"))
    name = F.regexp_extract("file", "/file=([^/]+)/", 1)
    files = deliveries.report(spark, landed, ledger, within).where(~F.col("file").contains("/_"))
    files = files.groupBy(name.alias("delivery"), "status").agg(F.max(F.regexp_extract("like", "/file=([^/]+)/", 1)).alias("like"))
    taken = sinks.read_routed(spark, f"{root}/out/records").groupBy(F.col("file").alias("delivery"))
    taken = taken.agg(F.count(F.lit(1)).alias("n_records"))
    return files.join(taken, "delivery", "left").select("delivery", "status", "like", F.coalesce("n_records", F.lit(0)).alias("n_records"))


def arrival_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per arriving file. Its time is left out, which no SQL can know."""
    out, path = new_folder(spark, "arrivals"), landing(spark, sf_dir)
    _finish(arrivals.log_arrivals(spark, path, f"{out}/log", f"{out}/checkpoint"))
    log = spark.read.parquet(f"{out}/log")
    whole = F.concat("key", F.lit(" uploaded in "), "bucket", F.lit(" at "), "at")
    file = F.substring_index(F.substring_index("key", "/", 1), "=", -1)
    named = F.col("key").rlike("^file=extract_[0-9]+/part-[^/]+$") & (F.col("bucket") == X.base_name(F.lit(path)))
    return log.groupBy(file.alias("file")).agg(
        F.bool_and(F.col("message") == whole).alias("complete"), F.bool_and(named).alias("named")
    )


def arrival_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of files whose times of arrival were set, an hour apart by extract; parts keep no name."""
    root = new_folder(spark, "timed")
    landed, p = f"{root}/zone", spark._jvm.org.apache.hadoop.fs.Path
    rows = all_lines(spark, sf_dir).select(extract_name(F.col("extract")).alias("file"), "value")
    rows.hint("rebalance", "file").write.partitionBy("file").text(landed)
    fs = p(landed).getFileSystem(spark._jsc.hadoopConfiguration())
    for extract_folder in fs.listStatus(p(landed)):
        name = extract_folder.getPath().getName()
        for part in fs.listStatus(extract_folder.getPath()) if "=" in name else []:
            fs.setTimes(part.getPath(), 1000 * (FIRST_ARRIVAL + 3600 * int(name.rsplit("_", 1)[1])), -1)
    _finish(arrivals.log_arrivals(spark, landed, f"{root}/log", f"{root}/checkpoint"))
    log = spark.read.parquet(f"{root}/log").where(F.col("key").startswith("file="))
    message = F.regexp_replace("message", "/part-[^ ]+ ", "/part ")
    return log.select(F.regexp_extract("key", "^file=([^/]+)/", 1).alias("file"), "bucket", "at", message.alias("message")).distinct()


#: When the first extract arrives, in seconds.
FIRST_ARRIVAL = 1_700_000_000


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arriving in several files; the newest one per user and day is kept."""
    root = new_folder(spark, "stream_upsert")
    events = table(spark, sf_dir, "events").withColumn("dt", F.col("ts").cast("date"))
    events.repartition(6).write.option("maxRecordsPerFile", KEYS_PER_STEP).parquet(f"{root}/arrivals")
    stream = arrivals.parquet_stream(spark, f"{root}/arrivals", events.schema, 2)
    cfg = C.HistoryConfig("events", ("user_id",), "ts", tie_breakers=("event_id",))
    _finish(arrivals.upsert_arrivals(stream, f"{root}/table", cfg, f"{root}/checkpoint"))
    return tables.read_append(spark, f"{root}/table").select("dt", "user_id", "event_id", "event_type", "value")


# ---- the whole batch -----------------------------------------------------------------------------


def _typed(*names: str) -> T.StructType:
    return C.schema_of({"t": {"columns": [{"name": n, "type": t} for n, t in (x.split(":") for x in names)]}}, "t")


def _jobs() -> list[batch.TypeJob]:
    cust = _typed("REC_TYPE:string", "CUST KEY:integer", "NAME:string", "SEGMENT:string")
    orders = _typed("REC_TYPE:string", "ORDER_KEY:integer", "CUST_KEY:integer", "PRIORITY:string", "BATCH_DATE:date")
    items = _typed("REC_TYPE:string", "ORDER_KEY:integer", "LINE:integer", "FLAG:string")
    rules = lambda *texts: C.rules_of({"t": "[" + ", ".join(texts) + "]"}, "t")
    return [
        batch.TypeJob(
            "9000",
            cust,
            rules("ColumnCount = 4", "ColumnValues 'REC_TYPE' = '9000'", "IsUnique 'CUST KEY'", "ColumnLength 'SEGMENT' = 9"),
        ),
        batch.TypeJob(
            "9005",
            orders,
            rules("ColumnCount = 5", "ColumnDataType 'CUST_KEY' = 'NUMBER'", "IsUnique 'ORDER_KEY'", "IsComplete 'BRANCH'"),
            history=C.HistoryConfig("9005", ("order_key",), "batch_date"),
            transpose=C.TransposeConfig(("CUST_KEY", "BATCH_DATE"), "PRIORITY", "ORDER_KEY", order_by=("ORDER_KEY",)),
            wide_history=C.HistoryConfig("9005", ("cust_key",), "batch_date"),
        ),
        batch.TypeJob("9006", items, rules("ColumnValues 'FLAG' in ['A', 'N']")),
    ]


def whole_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the extract; row counts per stage and record type."""
    return batch.run(spark, lines(spark, sf_dir), new_folder(spark, "batch"), _jobs(), RUN_DATE)


# ---- the batch from its configs -------------------------------------------------------------------

#: Lines of orders by line number are types of their own; the last one's history names a column that is not there.
ITEM_TYPES = [f"901{n}" for n in range(1, 8)]


def _config_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, value) of ten record types in four extracts, with right footers. Some orders have a broken key, some
    no priority field, and some a day that is none."""
    text = lambda c: F.col(c).cast("string")
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    key = F.col("o_orderkey")
    order = F.concat_ws(
        "|",
        F.lit("9005"),
        F.when(key % 11 == 0, F.concat(text("o_orderkey"), F.lit("x"))).otherwise(text("o_orderkey")),
        text("o_custkey"),
        F.when(key % 13 > 0, F.col("o_orderpriority")),
        F.when(key % 7 == 0, F.lit("20240230")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")),
    )
    cells = [
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("9000").alias("t"), F.concat_ws("|", F.lit("9000"), text("c_custkey"), "c_mktsegment").alias("value")),
        table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("9020").alias("t"), F.concat_ws("|", F.lit("9020"), text("s_suppkey"), "s_name").alias("value")),
        orders.select(key.alias("k"), F.lit("9005").alias("t"), order.alias("value")),
        items.select(
            F.col("l_orderkey").alias("k"),
            F.concat(F.lit("901"), text("l_linenumber")).alias("t"),
            F.concat_ws("|", F.concat(F.lit("901"), text("l_linenumber")), text("l_orderkey"), "l_returnflag", text("l_suppkey")).alias("value"),
        ),
    ]
    rows = reduce(DataFrame.unionByName, cells).select(F.concat(F.lit("extract_"), (F.col("k") % 4).cast("string")).alias("file"), "t", "value")
    totals = rows.groupBy("file", "t").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.array_join(F.collect_list(F.concat_ws("~", "t", F.col("n").cast("string"))), "|")
    footers = totals.groupBy("file").agg(F.concat(F.lit("T|"), pairs).alias("value"))
    return rows.select("file", "value").unionByName(footers)


def _write_configs(spark: SparkSession, root: str) -> dict[str, str]:
    column = lambda x: dict(zip(("name", "type"), x.split(":")))
    schema = lambda *names: {"columns": [column(x) for x in ("REC_TYPE:string", *names)]}
    item = schema("ORDER_KEY:integer", "FLAG:string", "SUPP_KEY:integer")
    keyed = lambda keys, day, **more: {"primary_keys": keys, "Batch_date": day, **more}
    configs = {
        "schemas": {
            "9000": schema("CUST_KEY:integer", "SEGMENT:string"),
            "9005": schema("ORDER_KEY:integer", "CUST_KEY:integer", "PRIORITY:string", "BATCH_DATE:date"),
            "rec_type_9020": schema("SUPP_KEY:integer", "NAME:string"),
            **{t: item for t in ITEM_TYPES},
        },
        "rules": {
            "9000": "[IsUnique 'CUST_KEY', IsUnique 'SEGMENT', ColumnLength 'SEGMENT' = 9]",
            "9005": "[ColumnCount = 5, IsComplete 'PRIORITY']",
            "rec_type_9020": "[]",
            **{f"rec_type_{t}": "[ColumnValues 'FLAG' in ['A', 'N']]" for t in ITEM_TYPES},
        },
        "histories": {
            "9005": keyed("ORDER_KEY", "BATCH_DATE"),
            "9011": keyed(["ORDER_KEY"], "SUPP_KEY", style="append"),
            ITEM_TYPES[-1]: keyed(["NOT_THERE"], "SUPP_KEY", style="append"),
        },
        "transposes": {"9005": {"group_by_cols": ["CUST_KEY"], "pivot_cols": ["PRIORITY"], "agg_cols": ["ORDER_KEY"]}},
    }
    for name, config in configs.items():
        spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(f"{root}/{name}")
    return {name: f"{root}/{name}" for name in configs}


def batch_from_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten types, side by side, as their JSON configs say; one fails, malformed records are set aside."""
    root = new_folder(spark, "configured")
    lines = _config_lines(spark, sf_dir)
    lines.hint("rebalance", "file").write.partitionBy("file").text(f"{root}/landing")
    jobs = batch.jobs_of(spark, **_write_configs(spark, root))
    landed = readers.read_lines(spark, f"{root}/landing", folder="file")
    return batch.run(spark, landed, f"{root}/out", jobs, RUN_DATE, on_error="report")


def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's line as the typed read found it: sound, or set aside with the reason."""
    root = new_folder(spark, "malformed")
    jobs = batch.jobs_of(spark, **_write_configs(spark, root), types=["9005"])
    recs = extract.records(_config_lines(spark, sf_dir))
    stored, _ = batch.check_records(recs, jobs[0], f"{root}/outcomes")
    sound = stored.select(F.col("ORDER_KEY").cast("string").alias("key"), F.lit(None).cast("string").alias("reason"))
    bad = sinks.read_malformed(spark, f"{root}/outcomes")
    return sound.unionByName(bad.select(F.get(F.split("line", r"\|", -1), F.lit(1)).alias("key"), "reason"))


def stream_upsert_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upserts from the state of the stream, then folded into an append history in two steps."""
    root = new_folder(spark, "stream_state")
    events = table(spark, sf_dir, "events").withColumn("dt", F.col("ts").cast("date"))
    cfg, last = C.HistoryConfig("events", ("user_id",), "ts", tie_breakers=("event_id",)), -1
    for half in range(2):
        mine = events.where(F.col("event_id") % 2 == half)
        mine.repartition(3).write.option("maxRecordsPerFile", KEYS_PER_STEP).mode("append").parquet(f"{root}/arrivals")
        stream = arrivals.parquet_stream(spark, f"{root}/arrivals", events.schema, 2)
        _finish(arrivals.upsert_changes(stream, f"{root}/table", cfg, f"{root}/checkpoint"))
        last = arrivals.fold(spark, f"{root}/table", f"{root}/history", cfg, last)
    return tables.read_append(spark, f"{root}/history").select("dt", "user_id", "event_id", "event_type", "value")


def checked_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts that land on two days: each is checked by one run and moved away; what each run took and what is left."""
    root = new_folder(spark, "ledger")
    landed, ledger_path = f"{root}/landing", f"{root}/ledger"
    rows = all_lines(spark, sf_dir).withColumn("file", extract_name(F.col("extract")))
    for run, of_run in (("1", F.col("extract") % 4 < 2), ("2", F.col("extract") % 4 >= 2)):
        mine = rows.where(of_run).select("file", "value").hint("rebalance", "file")
        mine.write.mode("append").partitionBy("file").text(landed)
        ledger.check_new(spark, landed, f"{root}/out", ledger_path, f"{root}/archive", "file", run)
    routed = ledger.records(spark, f"{root}/out", ledger_path).groupBy("file", F.col("run").cast("string").alias("run"))
    found = ledger.entries(spark, ledger_path).join(routed.agg(F.count(F.lit(1)).alias("routed")), ["file", "run"])
    left = len(ledger.pending(spark, landed, f"{root}/none", "file"))
    return found.select("file", "run", "status", "n_records", "routed", F.lit(left).alias("n_left"))


QUERIES = {
    f.__name__: f
    for f in (
        scalar_functions,
        missing_input,
        catalog_register,
        catalog_crawl,
        catalog_read,
        catalog_sql,
        stream_ingest,
        stream_assembly,
        stream_deliveries,
        arrival_log,
        arrival_messages,
        stream_upsert,
        stream_upsert_state,
        checked_once,
        whole_batch,
        batch_from_configs,
        malformed_records,
    )
}

_NEWEST_EVENTS = """
    SELECT CAST(ts AS DATE) AS dt, user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) = 1"""

_CONFIGURED = """
    WITH o AS (
      SELECT *, o_orderkey % 11 = 0 AS broken, o_orderkey % 13 = 0 AS short, o_orderkey % 7 = 0 AS no_day FROM orders
    ),
    bad AS (
      SELECT o_orderkey || CASE WHEN broken THEN 'x' ELSE '' END AS key,
             nullif(concat_ws('; ', CASE WHEN short THEN '4 fields, not 5' END,
               CASE WHEN broken OR no_day AND NOT short
                 THEN 'unreadable: ' || concat_ws(', ', CASE WHEN broken THEN 'ORDER_KEY' END,
                                                        CASE WHEN no_day AND NOT short THEN 'BATCH_DATE' END) END), '') AS reason,
             o_custkey FROM o
    )
"""

ORACLE = {
    "malformed_records": _CONFIGURED + "SELECT key, reason FROM bad",
    "batch_from_configs": _CONFIGURED
    + """, recs AS (
        SELECT c_custkey % 4 AS e, '9000' AS rec_type, length(c_mktsegment) = 9 AND false AS ok FROM customer
        UNION ALL SELECT s_suppkey % 4, '9020', true FROM supplier
        UNION ALL SELECT o_orderkey % 4, '9005', true FROM orders
        UNION ALL SELECT l_orderkey % 4, '901' || l_linenumber, l_returnflag IN ('A', 'N') FROM lineitem
    ),
    sound AS (SELECT * FROM bad WHERE reason IS NULL)
    SELECT 'route_pass' AS stage, rec_type, count(*) AS n FROM recs GROUP BY ALL
    UNION ALL SELECT 'check_pass', rec_type, count(DISTINCT e) FROM recs GROUP BY ALL
    UNION ALL SELECT 'rows_pass', rec_type, count(*) FILTER (ok) FROM recs WHERE rec_type NOT IN ('9005', '9017') GROUP BY ALL
    UNION ALL SELECT 'rows_fail', rec_type, count(*) FILTER (NOT ok) FROM recs WHERE rec_type NOT IN ('9005', '9017') GROUP BY ALL
    UNION ALL SELECT 'rows_malformed', rec_type, 0 FROM recs WHERE rec_type NOT IN ('9005', '9017') GROUP BY ALL
    UNION ALL SELECT 'rules_fail', rec_type, CASE rec_type WHEN '9000' THEN 2 WHEN '9020' THEN 0 ELSE 1 END
              FROM recs WHERE rec_type NOT IN ('9005', '9017') GROUP BY ALL
    UNION ALL SELECT 'rows_pass', '9005', count(*) FROM sound
    UNION ALL SELECT 'rows_fail', '9005', 0
    UNION ALL SELECT 'rows_malformed', '9005', count(*) FROM bad WHERE reason IS NOT NULL
    UNION ALL SELECT 'rules_fail', '9005', 0
    UNION ALL SELECT 'history', '9005', count(*) FROM sound
    UNION ALL SELECT 'history', '9011', count(DISTINCT l_orderkey) FROM lineitem WHERE l_linenumber = 1 AND l_returnflag IN ('A', 'N')
    UNION ALL SELECT 'wide', '9005', count(DISTINCT o_custkey) FROM sound
    UNION ALL SELECT 'error', '9017', 1""",
    "scalar_functions": """
        WITH s AS (
          SELECT *, CAST(o_orderkey AS VARCHAR) AS k,
                 o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts,
                 CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders
        )
        SELECT o_orderkey, 4 AS n_fields, '9005' AS first_part, '9005' AS first_field, o_orderpriority AS last_field,
               o_orderstatus AS pair_key, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS pair_count,
               o_orderpriority AS stripped, 'rec_type_' || k || '.txt' AS file_name, d AS day, d AS batch_day,
               CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS day_before, DATE '9999-12-31' AS open_end,
               DATE '2024-09-02' AS run_day, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS flag,
               o_orderstatus = 'O' AS is_open, strftime(ts, 'dt=%Y-%m-%d') AS day_folder,
               strftime(ts, '%Y/%m/%d/%H') AS hour_folder, 'file.txt' AS base_name, k AS folder,
               'landing-zone' AS bucket, 'day/' || k || '/file.txt' AS object_key,
               'file.txt uploaded in landing-zone at ' || strftime(ts, '%Y-%m-%d') AS message
        FROM s""",
    "missing_input": "SELECT o_orderkey, 0 AS folder, 1 AS n_present FROM orders",
    "catalog_register": """
        SELECT CAST(o_orderkey AS INTEGER) AS _c0, CAST(o_custkey AS INTEGER) AS _c1, o_orderstatus AS _c2 FROM orders""",
    "catalog_crawl": """
        SELECT 'daily_orders' AS "table", 'bigint, double, date, string' AS types, count(*) AS n_rows, 'changed' AS change FROM orders
        UNION ALL SELECT 'customers', 'bigint, string, string', count(*), 'grown' FROM customer
        UNION ALL SELECT 'suppliers', 'int, string', count(*), 'same' FROM supplier""",
    "catalog_read": "SELECT * FROM customer",
    "catalog_sql": """
        SELECT n_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY ALL""",
    "stream_ingest": with_lines(
        "SELECT r.file, r.rec_type, r.line, c.status FROM recs r JOIN checked c USING (file, rec_type)"
    ),
    "stream_assembly": with_lines(
        """SELECT file, rec_type, actual, declared, status, CASE WHEN status = 'pass' THEN 'complete'
               WHEN CAST(split_part(file, '_', 2) AS BIGINT) % 4 = 2 THEN 'bad footer' ELSE 'counts differ' END AS reason,
               actual AS routed FROM checked"""
    ),
    "stream_deliveries": with_lines(
        """SELECT file AS delivery, 'taken' AS status, CAST(NULL AS VARCHAR) AS "like", count(*) AS n_records FROM recs GROUP BY file
        UNION ALL SELECT DISTINCT file || '_again', 'repeated', file, 0 FROM recs
        UNION ALL SELECT 'late', 'late', NULL, 0"""
    ),
    "arrival_messages": with_lines(
        f"""SELECT DISTINCT file, 'zone' AS bucket, moment AS "at", 'file=' || file || '/part uploaded in zone at ' || moment AS message
        FROM (SELECT file, strftime(make_timestamp(1000000 * ({FIRST_ARRIVAL} + 3600 * CAST(extract AS BIGINT))), '%Y-%m-%dT%H:%M:%SZ') AS moment
              FROM recs)"""
    ),
    "arrival_log": with_lines("SELECT DISTINCT file, true AS complete, true AS named FROM recs"),
    "whole_batch": with_lines(
        """, good AS (SELECT r.*, c.status FROM recs r JOIN checked c USING (file, rec_type)),
        passed AS (
          SELECT *, CASE rec_type WHEN '9000' THEN length(split_part(line, '|', 4)) = 9
                                  WHEN '9006' THEN split_part(line, '|', 4) IN ('A', 'N') ELSE true END AS ok
          FROM good WHERE status = 'pass'
        )
        SELECT 'route_' || status AS stage, rec_type, count(*) AS n FROM good GROUP BY ALL
        UNION ALL SELECT 'check_' || status, rec_type, count(*) FROM checked GROUP BY ALL
        UNION ALL SELECT 'rows_pass', rec_type, count(*) FILTER (ok) FROM passed GROUP BY ALL
        UNION ALL SELECT 'rows_fail', rec_type, count(*) FILTER (NOT ok) FROM passed GROUP BY ALL
        UNION ALL SELECT 'rules_fail', rec_type, 1 FROM passed GROUP BY ALL
        UNION ALL SELECT 'history', rec_type, count(*) FROM passed WHERE rec_type = '9005' GROUP BY ALL
        UNION ALL SELECT 'wide_history', rec_type, count(DISTINCT split_part(line, '|', 3)) FROM passed
                  WHERE rec_type = '9005' GROUP BY ALL
        UNION ALL SELECT 'wide', rec_type, count(DISTINCT split_part(line, '|', 3) || '|' || split_part(line, '|', 5))
                  FROM passed WHERE rec_type = '9005' GROUP BY ALL"""
    ),
    "checked_once": with_lines(
        """SELECT file, CASE WHEN CAST(split_part(file, '_', 2) AS BIGINT) % 4 < 2 THEN '1' ELSE '2' END AS run,
                  CASE WHEN count(*) FILTER (status = 'fail') > 0 THEN 'fail' ELSE 'pass' END AS status,
                  CAST(sum(actual) AS BIGINT) AS n_records, CAST(sum(actual) AS BIGINT) AS routed, 0 AS n_left
           FROM checked GROUP BY file"""
    ),
    "stream_upsert_state": _NEWEST_EVENTS,
    "stream_upsert": """
        SELECT CAST(ts AS DATE) AS dt, user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts DESC, event_id DESC) = 1""",
}
