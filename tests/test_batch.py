"""The batch from its configs: types side by side, malformed records, rules."""

import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import config as C
from tallyfold.operators import quality
from tallyfold.plans import batch
from tallyfold.sources import readers, sinks, tables


@pytest.fixture
def configs(spark, folder):
    def write(**parts):
        for name, part in parts.items():
            spark.createDataFrame([(json.dumps(part),)], "value string").coalesce(1).write.text(f"{folder}/{name}")
        return {name: f"{folder}/{name}" for name in parts}

    return write


def columns(*names):
    return {"columns": [dict(zip(("name", "type"), n.split(":"))) for n in ("REC_TYPE:string", *names)]}


def test_jobs_come_from_configs(spark, configs):
    paths = configs(
        schemas={"1": columns("K:integer"), "rec_type_2": columns("DAY_DATE:date"), "3": columns("K:integer")},
        rules={"rec_type_1": "[IsUnique 'K']", "2": "[]"},
        histories={"1": {"primary_keys": "K", "Batch_date": "K", "style": "append", "stamp": False}},
    )
    one, two = batch.jobs_of(spark, **paths, types=["1", "2"])
    assert (one.rec_type, one.history_style, one.stamp, [r.text for r in one.rules]) == ("1", "append", False, ['IsUnique "K"'])
    assert (two.rec_type, two.history, list(two.rules)) == ("2", None, [])
    with pytest.raises(C.ConfigError, match="3 is not configured"):
        batch.jobs_of(spark, **paths)
    with pytest.raises(C.ConfigError):
        batch.jobs_of(spark, **paths, types=["4"])


LINES = [("f", x) for x in ("A|1|x", "A|2|y", "B|1|p", "B|1|p", "C|q|z", "T|A~2|B~2|C~1")]


def _job(rec_type, **more):
    return batch.TypeJob(rec_type, T.StructType.fromDDL("REC string, K int, V string"), **more)


def test_one_type_failing_does_not_stop_the_others(spark, rows, folder):
    lines = spark.createDataFrame(LINES, "file string, value string")
    broken = C.HistoryConfig("B", ("none",), "v")
    jobs = [_job("A"), _job("B", history=broken, history_style="append"), _job("C", quarantine=True)]
    out = batch.run(spark, lines, f"{folder}/1", jobs, "2024-01-01", on_error="report")
    got = {(r.stage, r.rec_type): r.n for r in out.collect()}
    assert got["rows_pass", "A"] == 2 and got["error", "B"] == 1 and ("rows_pass", "B") not in got
    assert (got["rows_pass", "C"], got["rows_malformed", "C"]) == (0, 1)
    assert "none" in spark.read.json(f"{folder}/1/B/error").head().message
    with pytest.raises(batch.BatchError) as e:
        batch.run(spark, lines, f"{folder}/2", jobs, "2024-01-01", parallel=1)
    assert list(e.value.failures) == ["B"]
    assert spark.read.parquet(f"{folder}/2/A/outcomes").count() == 2
    with pytest.raises(ValueError):
        batch.run(spark, lines, f"{folder}/3", jobs, "2024-01-01", on_error="ignore")


def test_types_run_side_by_side_in_pools_with_the_callers_properties(spark, folder, monkeypatch):
    seen = []
    real = batch.check_records

    def watched(recs, job, path):
        get = spark.sparkContext.getLocalProperty
        seen.append((job.rec_type, get("spark.scheduler.pool"), get("mine")))
        return real(recs, job, path)

    monkeypatch.setattr(batch, "check_records", watched)
    spark.sparkContext.setLocalProperty("mine", "kept")
    try:
        batch.run(spark, spark.createDataFrame(LINES, "file string, value string"), folder, [_job("A"), _job("B")], "2024-01-01").collect()
    finally:
        spark.sparkContext.setLocalProperty("mine", None)
    assert sorted(seen) == [("A", "type_A", "kept"), ("B", "type_B", "kept")]


def test_rows_that_bring_their_load_date(spark, rows, folder):
    cfg = C.HistoryConfig("A", ("k",), "n")
    data = spark.createDataFrame([(1, 1, "2024-01-01"), (1, 2, "2024-01-02")], "k int, n int, d string")
    own = data.select("k", "n", F.col("d").cast("date").alias("dt"))
    batch.load_history(spark, own, cfg, folder, "2030-01-01", "append", stamp=False)
    assert [str(d) for _, d in rows(tables.read_append(spark, folder), "k", "dt")] == ["2024-01-01", "2024-01-02"]


MALFORMED = ["9|1|1.5|20240101", "9|x|1|20240101", "9|2|2|20240230", "9|3", "9|4|4|20240101|more", '9|5|"6"|', "9|y|z|nodate", "9|||"]


def test_nothing_is_nulled_without_a_trace(spark, folder):
    recs = spark.createDataFrame([("9", x) for x in MALFORMED], "rec_type string, line string")
    schema = T.StructType.fromDDL("REC string, N int, D decimal(5,2), X_DATE string")
    want = {
        MALFORMED[1]: "unreadable: N",
        MALFORMED[2]: "unreadable: X_DATE",
        MALFORMED[3]: "2 fields, not 4",
        MALFORMED[4]: "5 fields, not 4",
        MALFORMED[6]: "unreadable: N, D, X_DATE",
    }
    for quarantine in (False, True):
        path = f"{folder}/{quarantine}"
        stored, rules = batch.check_records(recs, batch.TypeJob("9", schema, (C.is_complete("N"),), quarantine=quarantine), path)
        bad = sinks.read_malformed(spark, path).collect()
        assert {r.line: r.reason for r in bad} == want
        assert stored.count() + quarantine * len(bad) == len(MALFORMED)
        assert {r.status for r in bad} == ({"malformed"} if quarantine else {"pass", "fail"})
        assert rules.head().n_rows == stored.count() and sinks.MALFORMED not in stored.columns
    with pytest.raises(ValueError):
        readers.typed_records(recs, schema, "N")


def test_unique_rules_share_one_exchange(spark, folder, monkeypatch):
    kept = []
    real = quality.write_measured
    monkeypatch.setattr(quality, "write_measured", lambda df, name: (kept.append(df), real(df, name))[1])
    df = spark.sql("select id, cast(id % 9 as double) a, cast(id % 1000 as string) b, id % 7 c from range(1000)")
    df = df.union(spark.sql("select 5L, -0.0D, cast(null as string), 8L"))
    out = quality.row_outcomes(df, [C.is_unique(x) for x in ("id", "a", "b", "c", "a")])
    assert len(kept) == 1
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    failed = {(r.id, r.b): r[quality.ROWS_FAIL] for r in out.collect()}
    assert failed[5, None] == ['IsUnique "id"', 'IsUnique "a"', 'IsUnique "a"'] and failed[7, "7"] == ['IsUnique "a"', 'IsUnique "c"', 'IsUnique "a"']
