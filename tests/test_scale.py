"""Hot keys, and the shape of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from tallyfold import config as C
from tallyfold.config import HistoryConfig
from tallyfold.operators import extract, filecheck, history as H, joins, quality
from tallyfold.operators.transpose import transpose
from tallyfold.session import materialise
from tallyfold.sources import readers, tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot_rows(spark):
    """A third of the rows have one key, another sixth a null key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 200_000)
    return spark.range(0, 240_000, 1, 24).select("id", key.cast("int").alias("k"))


def test_hot_keys_are_found(spark, hot_rows):
    fans = {r[0]: r[1] for r in joins.hot_keys(hot_rows, ["k"]).collect()}
    hashes = spark.sql("select xxhash64(7) a, xxhash64(cast(null as int)) b").head()
    assert set(fans) == set(hashes) and fans[hashes.a] > fans[hashes.b] > 2
    assert joins.hot_keys(spark.range(100_000), ["id"]).isEmpty()
    assert joins.hot_keys(spark.range(0), ["id"]).isEmpty()


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_salted_join_is_whole_and_even(spark, hot_rows, kind):
    table = spark.range(0, 200_000, 2).select(F.col("id").cast(kind).alias("k"), (F.col("id") * 3).alias("v"))
    table = table.unionByName(spark.sql(f"select cast(null as {kind}) k, -1L v")).unionByName(
        spark.sql(f"select cast(7 as {kind}) k, 21L v")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.salted_left_join(hot_rows.withColumn("hash", F.lit(1)), materialise(table, "t"), ["k"])
        want = F.when(F.col("k").isNull(), -1).when((F.col("k") == 7) | (F.col("k") % 2 == 0), F.col("k") * 3)
        assert joined.columns == ["id", "k", "hash", "v"]
        assert joined.count() == 240_000
        assert joined.where(~F.col("v").eqNullSafe(want)).isEmpty()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 240_000 / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def nothing_is_small(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)


def test_unique_check_on_hot_values(hot_rows, nothing_is_small):
    out = quality.row_outcomes(hot_rows, [C.is_unique("k")])
    once = hot_rows.groupBy("k").count().where("count = 1").count()
    assert out.count() == 240_000
    assert quality.passed_rows(out).count() == once > 0


def test_lookup_gives_the_same_either_way(spark, hot_rows, rows, monkeypatch):
    table = spark.range(0, 100).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    small = rows(joins.lookup(hot_rows, table, ["k"]).groupBy("k", "v").count())
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    assert rows(joins.lookup(hot_rows, table, ["k"]).groupBy("k", "v").count()) == small
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10**6)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    assert rows(joins.lookup(hot_rows, table, ["k"]).groupBy("k", "v").count()) == small


def test_merge_gives_the_same_when_the_batch_is_large(spark, rows, monkeypatch):
    for cfg in (HistoryConfig("t", ("k",), "day"), HistoryConfig("t", ("k",), "day", joining_key=("g",))):
        base = spark.range(1000).select("id", F.col("id").alias("k"), (F.col("id") % 3).alias("g"), F.lit("2024-01-01").alias("day"))
        delta = base.where("k % 9 = 0").withColumn("day", F.lit("2024-02-01"))
        stored = materialise(H.merge(None, base, cfg, "2024-01-01"), "h")
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 500_000)
        small = rows(H.merge(stored, delta, cfg, "2024-02-01"))
        closed = rows(H.close_rows(stored, delta, cfg, "2024-02-01"))
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
        assert rows(H.merge(stored, delta, cfg, "2024-02-01")) == small
        assert rows(H.close_rows(stored, delta, cfg, "2024-02-01")) == closed


def test_file_check_scans_the_text_once_and_hashes(spark, lines, folder, monkeypatch):
    seen = []
    write = materialise
    monkeypatch.setattr(filecheck, "materialise", lambda df, name: (seen.append(plan(df)), write(df, name))[1])
    lines(a="9005|1\nT|9005~1").write.partitionBy("file").text(folder)
    filecheck.check_lines(readers.read_lines(spark, folder, folder="file"))
    (p,) = seen
    assert p.count("FileScan text") == 1
    assert p.count("Exchange") == 1 and "partial_sum" in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_file_check_unfolds_footers_only(spark, rows, lines, folder, monkeypatch):
    stored, write = [], materialise
    monkeypatch.setattr(filecheck, "materialise", lambda df, name: stored.append(write(df, name)) or stored[-1])
    text = "\n".join(f" 9005|{i}" for i in range(500))
    checks = filecheck.check_lines(lines(a=f"H|a\n{text}\nT|9005~1|9005~500\nT|9005~1|9005~500"))
    assert rows(stored[0].select("file", "rec_type", "n")) == [("a", "9005", 500), ("a", "T", 2)]
    assert rows(checks) == [("a", "9005", 500, 500, "pass")]


def test_newest_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    p = plan(H.newest(df, ["k"], ["n"]))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", p)


def test_record_check_needs_no_shuffle_for_few_repeats(spark, folder):
    spark.range(1000).selectExpr("id", "cast(id as string) s").write.parquet(folder)
    p = plan(quality.row_outcomes(spark.read.parquet(folder), [C.is_unique("id"), C.is_complete("s")]))
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p and "Python" not in p


def test_pivot_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 g", "cast(id % 2 as string) p", "id v")
    p = plan(transpose(df, C.TransposeConfig(("g",), "p", "v", pivot_values=("0", "1"))))
    assert "partial_first" in p


def test_old_open_rows_are_not_read(spark, folder):
    cfg = HistoryConfig("t", ("k",), "day")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        tables.commit_history(spark, folder, spark.range(3).selectExpr("id k", f"'{day}' day"), cfg, day)
    history = tables.read_history(spark, folder)
    scan = re.search(r"FileScan.*", plan(history)).group(0)
    assert "PartitionFilters: [" in scan and "current_record_flag" in scan.split("PartitionFilters")[1]
    open_rows = plan(tables.read_open(spark, folder))
    assert "history_version" in open_rows.split("PartitionFilters")[1]


def test_only_needed_columns_are_read(spark, folder):
    spark.range(100).selectExpr("id a", "id b", "id c").write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert "ReadSchema: struct<a:bigint>" in plan(quality.repeated_values(stored, "a"))
    out = quality.row_outcomes(stored, [C.is_complete("a")])
    out.write.parquet(folder + "-out")
    verdicts = quality.rule_outcomes(spark.read.parquet(folder + "-out"), [C.is_complete("a")], "t")
    assert "ReadSchema: struct<DataQualityRulesFail:array<string>>" in plan(verdicts)


def test_type_counts_read_no_more_than_the_line(spark, folder, lines):
    lines(a="9005|1").write.partitionBy("file").text(folder)
    p = plan(extract.type_counts(extract.records(readers.read_lines(spark, folder, folder="file"))))
    assert p.count("Exchange") == 1 and "partial_count" in p


@pytest.mark.parametrize(
    "name", ["checksum_route", "segregate_write", "row_outcomes", "scd2_merge", "scd2_close_by_group", "history_snapshot"]
)
def test_queries_without_broadcast(spark, sf_dir, nothing_is_small, name):
    import __spark_entry__ as entry
    from check import compare, connect

    assert compare(spark, connect(sf_dir), sf_dir, name, entry.queries()[name], entry.oracle_sql()[name]) == ""
