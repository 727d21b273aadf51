"""Discovery over a folder of mixed layouts, and the ledger and keyed state."""

import os

import pytest
from pyspark.sql import functions as F

from tallyfold.config import HistoryConfig
from tallyfold.plans import ledger
from tallyfold.sources import catalog, tables
from tallyfold.streaming import arrivals


@pytest.fixture
def database(spark):
    name = "tallyfold_crawled_" + os.urandom(4).hex()
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def text(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def changes(df):
    return {r.table: (r.kind, r.change) for r in df.collect()}


def kinds(spark, database, table):
    return [t for _, t in catalog.read_table(spark, database, table).dtypes]


def test_layouts_types_and_partitions(spark, rows, folder, database):
    text(spark, f"{folder}/raw/orders", "1|2024-01-01|a|1.5|", "2|2024-01-02|b|2|")
    text(spark, f"{folder}/raw/by day/dt=1", "7|x")
    spark.range(3).withColumn("p", F.lit("k")).write.partitionBy("p").parquet(f"{folder}/raw/deep/wide")
    text(spark, f"{folder}/raw/odd", "a|b")
    spark.range(1).write.mode("append").parquet(f"{folder}/raw/odd")
    found = changes(catalog.crawl(spark, database, f"{folder}/raw"))
    assert found == {"orders": ("text", "new"), "by_day": ("text", "new"), "deep_wide": ("parquet", "new"), "odd": ("mixed", "left out")}
    assert kinds(spark, database, "orders") == ["int", "date", "string", "double", "string"]
    assert kinds(spark, database, "by_day") == ["int", "string", "string"]
    assert rows(catalog.read_table(spark, database, "deep_wide"), "id", "p") == [(0, "k"), (1, "k"), (2, "k")]
    same = changes(catalog.crawl(spark, database, f"{folder}/raw"))
    assert {c for _, c in same.values()} == {"same", "left out"}

    text(spark, f"{folder}/raw/orders", "3000000000|n/a|c|3|more|0")
    text(spark, f"{folder}/raw/by day/dt=2", "8|y")
    found = changes(catalog.crawl(spark, database, f"{folder}/raw"))
    assert (found["orders"][1], found["by_day"][1], found["deep_wide"][1]) == ("changed", "grown", "same")
    assert kinds(spark, database, "orders") == ["bigint", "string", "string", "double", "string", "int"]
    assert rows(catalog.read_table(spark, database, "by_day")) == [(7, "x", "1"), (8, "y", "2")]
    assert catalog.read_table(spark, database, "orders").count() == 3
    hidden = [t.name for t in spark.catalog.listTables(database) if t.name.startswith("orders_")]
    assert len(hidden) == 1


def test_types_only_get_wider(spark, folder, database):
    assert [catalog.wider(a, b) for a, b in (("int", "double"), ("bigint", "int"), ("date", "int"), ("date", "date"))] == ["double", "bigint", "string", "date"]
    text(spark, f"{folder}/raw/t", "1.5")
    catalog.crawl(spark, database, f"{folder}/raw")
    spark._jvm.org.apache.hadoop.fs.Path(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/raw/t")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    text(spark, f"{folder}/raw/t", "2")
    assert changes(catalog.crawl(spark, database, f"{folder}/raw")) == {"t": ("text", "same")}
    assert kinds(spark, database, "t") == ["double"]


def land(spark, root, extract, *lines):
    text(spark, f"{root}/landing/file={extract}", *lines)


def check(spark, root, run):
    found = ledger.check_new(spark, f"{root}/landing", f"{root}/out", f"{root}/ledger", f"{root}/archive", "file", run)
    return sorted((r.file, r.rec_type, r.status) for r in found.collect())


def test_a_second_run_reads_only_new_extracts(spark, rows, folder):
    assert check(spark, folder, "0") == []
    land(spark, folder, "a", "1|x", "T|1~1")
    land(spark, folder, "b", "1|x", "2|y", "T|1~1|2~5")
    os.makedirs(f"{folder}/landing/file=void")
    open(f"{folder}/landing/file=void/none.txt", "w").close()
    assert check(spark, folder, "1") == [("a", "1", "pass"), ("b", "1", "pass"), ("b", "2", "fail"), ("void", None, "fail")]
    assert sorted(os.listdir(f"{folder}/archive/fail")) == ["file=b", "file=void"] and os.listdir(f"{folder}/landing") == []
    land(spark, folder, "c", "1|z", "T|1~1")
    assert check(spark, folder, "2") == [("c", "1", "pass")]
    assert check(spark, folder, "3") == []
    assert rows(ledger.entries(spark, f"{folder}/ledger")) == [("a", "pass", 1, "1"), ("b", "fail", 2, "1"), ("c", "pass", 1, "2"), ("void", "fail", 0, "1")]
    assert ledger.records(spark, f"{folder}/out", f"{folder}/ledger").count() == 4


def test_what_a_lost_run_left_is_done(spark, folder, monkeypatch):
    land(spark, folder, "a", "1|x", "T|1~1")
    real = ledger.move_checked
    monkeypatch.setattr(ledger, "move_checked", lambda *a: [])  # lost before the moves
    check(spark, folder, "1")
    monkeypatch.setattr(ledger, "move_checked", real)
    spark.createDataFrame([("f", "9|lost", 1, "pass", "9")], "file string, line string, declared long, status string, rec_type string").write.parquet(
        f"{folder}/out/run=lost"
    )
    assert check(spark, folder, "2") == [] and os.listdir(f"{folder}/archive/pass") == ["file=a"]
    assert ledger.records(spark, f"{folder}/out", f"{folder}/ledger").count() == 1


def test_the_stream_moves_what_it_took(spark, folder):
    text(spark, f"{folder}/in/one", "9|1", "T|9~1")
    stream = lambda: arrivals.line_stream(spark, f"{folder}/in/*", archive=f"{folder}/kept")
    for n in range(3):
        query = arrivals.ingest(stream(), f"{folder}/out", f"{folder}/cp")
        query.awaitTermination()
        assert query.exception() is None
        if n < 2:
            text(spark, f"{folder}/in/more{n}", f"9|{n}", "T|9~1")
    kept = [f for _, _, files in os.walk(f"{folder}/kept") for f in files if f.startswith("part-")]
    assert kept


def test_keyed_state_writes_what_changed(spark, rows, folder):
    cfg = HistoryConfig("t", ("k",), "n", tie_breakers=("v",))
    schema = "k int, n int, v string, dt date"

    def arrive(*cells):
        df = spark.createDataFrame([(k, n, v, d) for k, n, v, d in cells], "k int, n int, v string, d string")
        df.select("k", "n", "v", F.col("d").cast("date").alias("dt")).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = arrivals.parquet_stream(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
        query = arrivals.upsert_changes(stream, f"{folder}/t", cfg, f"{folder}/cp")
        query.awaitTermination()
        assert query.exception() is None

    arrive(*[(k, 1, "a", "2024-01-01") for k in range(100)], (None, 1, "a", None))
    arrive((5, 2, "b", "2024-01-01"), (6, 0, "old", "2024-01-01"), (5, 1, "c", "2024-01-02"))
    second = spark.read.parquet(f"{folder}/t/{arrivals.CHANGED}/batch=1")
    assert {(r.k, r.v) for r in second.collect()} <= {(5, "b"), (5, "c"), (6, "a")} and second.count() <= 3
    found = arrivals.latest(spark, f"{folder}/t", cfg)
    assert found.count() == 102 and rows(found.where("k in (5, 6)"), "k", "v") == [(5, "b"), (5, "c"), (6, "a")]
    at = arrivals.fold(spark, f"{folder}/t", f"{folder}/h", cfg)
    assert at == 1 and arrivals.fold(spark, f"{folder}/t", f"{folder}/h", cfg, at) == 1
    assert tables.read_append(spark, f"{folder}/h").count() == 102


def test_registering_again_keeps_the_table(spark, rows, folder, database, monkeypatch):
    catalog.ensure_database(spark, database, folder + "-db")
    spark.range(3).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(f"{folder}/t")
    catalog.register(spark, database, "t", f"{folder}/t", partitioned=True)
    spark.range(2).selectExpr("id", "7 p").write.mode("append").partitionBy("p").parquet(f"{folder}/t")
    seen = []
    real = spark.sql
    monkeypatch.setattr(spark, "sql", lambda q, *a, **k: (seen.append(q.split()[0]), real(q, *a, **k))[1])
    catalog.register(spark, database, "t", f"{folder}/t", partitioned=True)
    assert "DROP" not in seen and catalog.read_table(spark, database, "t").count() == 5
    spark.range(1).selectExpr("id", "1 more", "9 p").write.mode("append").partitionBy("p").parquet(f"{folder}/t")
    catalog.register(spark, database, "t", f"{folder}/t", partitioned=True)
    assert "DROP" in seen and catalog.read_table(spark, database, "t").columns == ["id", "more", "p"]
