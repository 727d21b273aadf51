import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tallyfold import config as C
from tallyfold.operators import columns, quality
from tallyfold.operators.quality import RESULT, ROWS_FAIL, ROWS_PASS, ROWS_SKIP
from tallyfold.plans import batch
from tallyfold.sources import readers, sinks


def test_schema_from_config():
    cfg = {"t": {"columns": [{"name": n, "type": n} for n in ("string", "integer", "double", "date", "timestamp", "decimal(10,2)")]}}
    assert [f.dataType for f in C.schema_of(cfg, "t")] == [
        T.StringType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampType(), T.DecimalType(10, 2),
    ]
    for bad in ("decimal(10, 2)", "decimal", "long"):
        with pytest.raises(C.ConfigError):
            C.field_type(bad)
    with pytest.raises(C.ConfigError):
        C.schema_of(cfg, "other")


def test_typed_lines(spark, rows):
    schema = T.StructType.fromDDL("a string, n int, d decimal(5,2), x_DATE string")
    src = spark.createDataFrame([('p|1|2.50|20240102',), ('"q|r"|x|y|20240230',), ("s",), ("t|1|1|20240101|more",)], "line string")
    typed = columns.parse_dates(readers.typed_records(src, schema))
    assert rows(typed) == [
        ("p", 1, Decimal("2.50"), dt.date(2024, 1, 2)),
        ("q|r", None, None, None),
        ("s", None, None, None),
        ("t", 1, Decimal("1.00"), dt.date(2024, 1, 1)),
    ]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["REC TYPE", "Disclosure APY", " a(b)-c", "X"])
    assert columns.clean_names(df).columns == ["rec_type", "disclosure_apy", "ab_c", "x"]
    with pytest.raises(C.ConfigError):
        columns.clean_names(spark.createDataFrame([(1, 2)], ["A B", "a_b"]))


def test_align_and_pick(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1,)], "y int")
    assert columns.align(a, b).columns == ["y"]
    assert columns.align(b, a, add_missing=True).collect() == [(None, 1)]
    with pytest.raises(C.ConfigError):
        columns.align(b, a)
    with pytest.raises(C.ConfigError):
        columns.pick(a, ["x", "z"])


RULE_TEXT = {
    "t": "[ColumnCount = 3, ColumnValues 'K' = 'a', ColumnValues 'K' in ['a', 'b'], ColumnLength 'K' = 1, "
    "ColumnDataType 'N' = 'NUMBER', IsUnique 'K', IsComplete 'K', IsComplete 'GONE']"
}


def test_rule_text():
    rules = C.rules_of(RULE_TEXT, "t")
    assert [r.kind for r in rules] == [
        "ColumnCount", "ColumnValues", "ColumnValues", "ColumnLength", "ColumnDataType", "IsUnique", "IsComplete", "IsComplete",
    ]
    assert rules[2].want == ("a", "b") and rules[3].want == 1
    swapped = {"t": "[" + ", ".join(r.text for r in rules) + "]"}
    assert C.rules_of(swapped, "t") == rules
    assert C.rules_of(RULE_TEXT, "unknown") == []
    with pytest.raises(C.ConfigError):
        C.rules_of({"t": "[RowCount > 3]"}, "t")


def test_nulls_and_unknown_columns(spark, rows):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), (None, None), (None, "2"), ("cc", "-1.5e3")], "K string, N string")
    rules = C.rules_of(RULE_TEXT, "t")[1:]
    out = quality.row_outcomes(df, rules)
    failed = {(r.K, r.N): {t.split()[0] + t.split()[-1] for t in r[ROWS_FAIL]} for r in out.collect()}
    assert failed == {
        ("a", "1"): set(),
        ("b", "x"): {'ColumnValues"a"', 'ColumnDataType"NUMBER"'},
        (None, None): {'ColumnValues"a"', 'ColumnValues"b"]', "ColumnLength1", 'ColumnDataType"NUMBER"', 'IsUnique"K"', 'IsComplete"K"'},
        (None, "2"): {'ColumnValues"a"', 'ColumnValues"b"]', "ColumnLength1", 'IsUnique"K"', 'IsComplete"K"'},
        ("cc", "-1.5e3"): {'ColumnValues"a"', 'ColumnValues"b"]', "ColumnLength1"},
    }
    assert all(r[ROWS_SKIP] == ['IsComplete "GONE"'] for r in out.collect())
    verdicts = {r.rule: (r.outcome, r.n_failed) for r in quality.rule_outcomes(out, rules, "t").collect()}
    assert verdicts['IsComplete "GONE"'] == ("Failed", 0)
    assert verdicts['IsUnique "K"'] == ("Failed", 2)
    assert verdicts['ColumnValues "K" = "a"'] == ("Failed", 4)


def test_no_rules_pass_every_row(spark):
    out = quality.row_outcomes(spark.range(3), [])
    assert quality.passed_rows(out).count() == 3 and quality.failed_rows(out).isEmpty()
    assert quality.rule_outcomes(out, [], "t").isEmpty()


def test_typed_columns_meet_type_names(spark):
    df = spark.sql("select 1 i, 1.5D d, date'2024-01-01' day, timestamp'2024-01-01 00:00:00' ts, cast(null as int) none")
    rules = [C.data_type(c, t) for c, t in (("i", "INTEGER"), ("d", "NUMBER"), ("day", "YYYYMMDD"), ("ts", "YYYYMMDDHHMMSS"))]
    row = quality.row_outcomes(df, [*rules, C.data_type("none", "NUMBER"), C.data_type("d", "INTEGER")]).head()
    assert row[ROWS_PASS] == [r.text for r in rules] and len(row[ROWS_FAIL]) == 2
    with pytest.raises(ValueError):
        quality.row_outcomes(df, [C.data_type("i", "FLOAT")])


def test_record_check_splits_everything(spark, rows, folder):
    recs = spark.createDataFrame([("9005", f"9005|{i % 4}|{'x' if i % 3 else ''}") for i in range(12)], "rec_type string, line string")
    job = batch.TypeJob("9005", T.StructType.fromDDL("REC string, N int, X string"), C.rules_of({"r": "[IsComplete 'X']"}, "r"))
    stored, rules = batch.check_records(recs, job, folder)
    assert rows(stored.groupBy("status").count()) == [("fail", 4), ("pass", 8)]
    assert [(r.outcome, r.n_rows, r.n_failed) for r in rules.collect()] == [("Failed", 12, 4)]
    assert set(stored.select("status", RESULT).distinct().collect()) == {("pass", "Passed"), ("fail", "Failed")}
    sinks.write_outcomes(stored.drop("status"), folder + "-again")
    sinks.write_outcomes(stored.drop("status"), folder + "-again")
    assert spark.read.parquet(folder + "-again").count() == 24


def test_configs(spark, folder):
    spark.createDataFrame([('{"dev": {"RAW": "raw"}}',)], "value string").coalesce(1).write.text(folder)
    cfg = C.read_json(spark, folder)
    assert C.entry(cfg, "dev") == {"RAW": "raw"}
    with pytest.raises(C.ConfigError):
        C.entry(cfg, "cg_dev")
    with pytest.raises(C.ConfigError):
        C.read_json(spark, folder + "-none")
    spark.createDataFrame([("{oops",)], "value string").coalesce(1).write.text(folder + "-bad")
    with pytest.raises(C.ConfigError):
        C.read_json(spark, folder + "-bad")
    h = C.HistoryConfig.of({"t": {"primary_keys": ["AR ID"], "Batch_date": "FULL_DATE", "Delete_indicator_column": ""}}, "t")
    assert (h.primary_keys, h.join_on, h.batch_date, h.delete_indicator) == (("ar_id",), ("ar_id",), "full_date", None)
    with pytest.raises(C.ConfigError):
        C.HistoryConfig.of({"t": {}}, "t")
    with pytest.raises(C.ConfigError):
        C.TransposeConfig.of({"t": {"group_by_cols": ["a"], "pivot_cols": ["b", "c"], "agg_cols": ["d"]}}, "t")
