"""Validity-dated histories in hash buckets."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from tallyfold.config import ConfigError, HistoryConfig
from tallyfold.operators import history as H
from tallyfold.sources import buckets, commits, tables
from workload import histories

CFG = HistoryConfig("t", ("k", "sub"), "day", delete_indicator="ind")
D = [f"2024-01-0{i}" for i in range(1, 7)]


def batch(spark, keys, v, day, ind="A"):
    return spark.createDataFrame([(k, f"s{k % 3}", v, day, ind) for k in keys], "k int, sub string, v string, day string, ind string")


def shown(rows, df):
    return rows(df, "k", "sub", "v", H.START, H.END, H.CURRENT, H.DELETED, H.LOADED)


def test_buckets_hold_what_plain_folders_hold(spark, rows, folder):
    loads = [batch(spark, range(50), "a", D[0]), batch(spark, range(0, 60, 7), "b", D[1], "D"), batch(spark, [7, 8, 100], "c", D[2])]
    loads += [batch(spark, [7, 8, 100], "c", D[2]), batch(spark, [], "x", D[3]), batch(spark, [1], "w", D[4]).withColumn("more", F.lit(1))]
    for n, load in enumerate(loads):
        at = tables.commit_history(spark, f"{folder}/plain", load, CFG, D[n])
        assert buckets.commit(spark, f"{folder}/buckets", load, CFG, D[n], n_buckets=8) == at
        assert shown(rows, buckets.read(spark, f"{folder}/buckets")) == shown(rows, tables.read_history(spark, f"{folder}/plain"))
    for at in range(5):
        assert shown(rows, buckets.read(spark, f"{folder}/buckets", at)) == shown(rows, tables.read_history(spark, f"{folder}/plain", at))
    assert rows(buckets.read_open(spark, f"{folder}/buckets").where("k = 1"), "v", "more") == [("w", 1)]
    assert spark.catalog.listTables() == [] or all(not t.name.startswith("history_") for t in spark.catalog.listTables())


def test_a_commit_reads_and_writes_only_its_buckets(spark, folder):
    buckets.commit(spark, folder, batch(spark, range(1000), "a", D[0]), CFG, D[0], n_buckets=32)
    few = batch(spark, [3, 33], "b", D[1])
    touched = sorted({r.b for r in few.select(buckets.bucket_of(["k", "sub"], 32).alias("b")).collect()})
    rows, name = buckets.open_table(spark, folder, buckets.manifest(spark, folder, 0), touched)
    assert {int(f.split(f"{buckets.BUCKET}=")[1].split("/")[0]) for f in rows.inputFiles()} == set(touched)
    spark.sql(f"DROP TABLE `{name}`")
    before = set(buckets.read_open(spark, folder).inputFiles())
    buckets.commit(spark, folder, few, CFG, D[1])
    assert commits.children(spark, f"{folder}/{buckets.COMMIT}=1/{H.CURRENT}=1") == sorted(f"{buckets.BUCKET}={b}" for b in touched)
    after = set(buckets.read_open(spark, folder).inputFiles())
    assert len(before & after) >= 32 - len(touched)


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_open_rows_are_not_shuffled(spark, folder, broadcast):
    buckets.commit(spark, folder, batch(spark, range(1000), "a", D[0]), CFG, D[0], n_buckets=16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows, name = buckets.open_table(spark, folder, buckets.manifest(spark, folder, 0))
        added = H.merge(None, batch(spark, range(0, 1000, 3), "b", D[1]), CFG, D[1])
        changes = buckets._changes(rows, added.select(*[c for c in added.columns]), ["k", "sub"], D[1], "run_date")
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.sql(f"DROP TABLE `{name}`")
    join = plan.index("FullOuter")
    scan = plan.index("Bucketed: true")
    # between the join and the scan of the open rows there is no exchange
    assert "Exchange" not in plan[join:scan] and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_writers_of_different_and_of_the_same_buckets(spark, rows, folder, monkeypatch):
    buckets.commit(spark, folder, batch(spark, range(40), "a", D[0]), CFG, D[0], n_buckets=16)
    written = []
    real = buckets._write
    monkeypatch.setattr(buckets, "_write", lambda *a: (written.append(1), real(*a)))
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda i: buckets.commit(spark, folder, batch(spark, [i, 200 + i], f"w{i}", D[i + 1]), CFG, D[i + 1]), range(4)))
    assert sorted(got) == [1, 2, 3, 4] and len(written) >= 4
    found = rows(buckets.read_open(spark, folder).where("v <> 'a'"), "k", "v")
    assert found == sorted(((k, f"w{i}") for i in range(4) for k in (i, 200 + i)), key=repr)
    assert buckets.read(spark, folder).count() == 40 + 8


def test_what_buckets_refuse(spark, folder):
    with pytest.raises(ConfigError):
        buckets.read(spark, folder)
    with pytest.raises(ConfigError):
        buckets.commit(spark, folder, batch(spark, [1], "a", D[0]), HistoryConfig("t", ("k",), "day", joining_key=("v",)), D[0])
    with pytest.raises(ConfigError):
        buckets.commit(spark, folder, batch(spark, [1], "a", D[0]).withColumn("sub", F.lit(None).cast("string")), CFG, D[0])
    assert buckets.commit(spark, folder, batch(spark, [], "a", D[0]), CFG, D[0]) == -1


def test_changes_come_in_any_order(spark, sf_dir, monkeypatch):
    """Of a changed customer's two versions the newer one counts, whichever is read first."""
    delta = histories._delta
    monkeypatch.setattr(histories, "_delta", lambda *a: delta(*a).coalesce(1).sortWithinPartitions(F.col("segment").desc()))
    assert compare(spark, connect(sf_dir), sf_dir, "scd2_buckets", histories.scd2_buckets, histories.ORACLE["scd2_buckets"]) == ""
