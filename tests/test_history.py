import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold import config as C
from tallyfold.config import HistoryConfig, TransposeConfig
from tallyfold.operators import history as H
from tallyfold.operators.transpose import transpose
from tallyfold.sources import tables

CFG = HistoryConfig("t", ("k",), "day", delete_indicator="ind")
D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def batch(spark, *cells):
    return spark.createDataFrame([tuple(c) for c in cells], "k int, v string, day string, ind string")


def short(rows, df):
    """(key, value, end, current, deleted) with the open end as None."""
    out = rows(df, "k", "v", H.END, H.CURRENT, H.DELETED)
    return [(k, v, None if e == H.OPEN_END else str(e), c, d) for k, v, e, c, d in out]


def test_life_of_keys(spark, rows):
    h = H.merge(None, batch(spark, (1, "a", D1, "A"), (2, "b", D1, None), (3, "c", D1, "A")), CFG, D1)
    h = H.merge(h, batch(spark, (2, "b2", D2, "C"), (3, "c", D2, "D"), (4, "d", D2, "A")), CFG, D2)
    h = H.merge(h, batch(spark, (3, "c3", D3, "A")), CFG, D3)
    assert short(rows, h) == [
        (1, "a", None, 1, 0),
        (2, "b", D2, 0, 0),
        (2, "b2", None, 1, 0),
        (3, "c", D2, 0, 0),
        (3, "c", D3, 0, 1),
        (3, "c3", None, 1, 0),
        (4, "d", None, 1, 0),
    ]
    assert h.where(F.col(H.CURRENT) == 1).groupBy("k").count().where("count > 1").isEmpty()
    assert rows(H.current_rows(h), "k") == [(1,), (2,), (3,), (4,)]


def test_strict_leaves_deletions_open(spark, rows):
    h = H.merge(None, batch(spark, (3, "c", D1, "D")), CFG, D1)
    h = H.merge(h, batch(spark, (3, "c3", D3, "A")), CFG, D3, strict_reference=True)
    assert short(rows, h) == [(3, "c", None, 1, 1), (3, "c3", None, 1, 0)]


@pytest.mark.parametrize("on,end", [("run_date", D2), ("day_before", D1), ("open", None)])
def test_end_dates(spark, rows, on, end):
    h = H.merge(None, batch(spark, (1, "a", D1, "A")), CFG, D1)
    h = H.merge(h, batch(spark, (1, "b", D2, "A")), CFG, D2, close_on=on)
    assert short(rows, h)[0] == (1, "a", end, 0, 0)
    with pytest.raises(C.ConfigError):
        H.end_date(D1, "never")


def test_same_batch_twice_is_a_no_op(spark, rows):
    first, second = batch(spark, (1, "a", D1, "A"), (2, "b", D1, "A")), batch(spark, (1, "a2", D2, "A"))
    for closing in (True, False):
        once = H.merge(H.merge(None, first, CFG, D1), second, CFG, D2, closing=closing)
        assert rows(H.merge(once, second, CFG, D2, closing=closing)) == rows(once)


def test_duplicate_keys_in_a_batch(spark, rows):
    h = H.merge(None, batch(spark, (1, "a", D1, "A")), CFG, D1)
    h = H.merge(h, batch(spark, (1, "old", "20240101", "A"), (1, "new", "20240102", "A"), (1, "none", None, "A")), CFG, D2)
    assert short(rows, h) == [(1, "a", D2, 0, 0), (1, "new", None, 1, 0)]


def test_null_keys_and_start_dates(spark, rows):
    h = H.merge(None, batch(spark, (None, "a", D1, "A"), (1, "x", None, "A")), CFG, D1)
    h = H.merge(h, batch(spark, (None, "b", D2, "A"), (1, "y", None, "A")), CFG, D2)
    assert short(rows, h) == [(1, "y", None, 1, 0), (None, "a", D2, 0, 0), (None, "b", None, 1, 0)]


def test_new_columns_arrive(spark, rows):
    h = H.merge(None, batch(spark, (1, "a", D1, "A"), (2, "b", D1, "A")), CFG, D1)
    wider = batch(spark, (1, "a2", D2, "A")).withColumn("extra", F.lit(7))
    h = H.merge(h, wider, CFG, D2)
    assert rows(h, "k", "v", "extra") == [(1, "a", None), (1, "a2", 7), (2, "b", None)]


def test_batch_date_layouts(spark, rows):
    h = H.new_rows(batch(spark, (1, "a", "2024-01-05", "A"), (2, "b", "20240105", "A"), (3, "c", "bad", "A")), CFG, D1)
    assert rows(h, "k", H.START) == [(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 5)), (3, None)]
    typed = batch(spark, (1, "a", "2024-01-05", "A")).withColumn("day", F.col("day").cast("date"))
    assert rows(H.new_rows(typed, CFG, D1), H.START) == [(dt.date(2024, 1, 5),)]
    timed = typed.withColumn("day", F.lit("2024-01-05 07:00:00").cast("timestamp"))
    assert rows(H.new_rows(timed, CFG, D1), H.START) == [(dt.date(2024, 1, 5),)]
    assert H.new_rows(typed, CFG).head()[H.LOADED] == spark.sql("select current_date()").head()[0]


def test_join_on_a_shared_key(spark, rows):
    cfg = HistoryConfig("t", ("k",), "day", joining_key=("v",))
    h = H.merge(None, batch(spark, (1, "g", D1, "A"), (2, "g", D1, "A"), (3, "h", D1, "A")), cfg, D1)
    h = H.merge(h, batch(spark, (9, "g", D2, "A"), (8, "g", D2, "A")), cfg, D2)
    assert [(r[0], r[3]) for r in short(rows, h)] == [(1, 0), (2, 0), (3, 1), (8, 1), (9, 1)]


def test_stored_history(spark, rows, folder):
    tables.commit_history(spark, folder, batch(spark, (1, "a", D1, "A"), (2, "b", D1, "A")), CFG, D1)
    tables.commit_history(spark, folder, batch(spark, (1, "a2", D2, "A")), CFG, D2)
    tables.commit_history(spark, folder, batch(spark, (2, "b2", D3, "A")).withColumn("extra", F.lit(1)), CFG, D3)
    whole = [(1, "a", D2, 0, 0), (1, "a2", None, 1, 0), (2, "b", D3, 0, 0), (2, "b2", None, 1, 0)]
    assert tables.versions(spark, folder) == [0, 1, 2]
    assert short(rows, tables.read_history(spark, folder)) == whole
    assert short(rows, tables.read_history(spark, folder, as_of=0)) == [(1, "a", None, 1, 0), (2, "b", None, 1, 0)]
    assert tables.expire_versions(spark, folder, keep=1) == [0, 1]
    assert short(rows, tables.read_history(spark, folder)) == whole
    tables.commit_history(spark, folder, batch(spark, (2, "b2", D3, "A")).withColumn("extra", F.lit(1)), CFG, D3)
    assert short(rows, tables.read_history(spark, folder)) == whole
    with pytest.raises(C.ConfigError):
        tables.read_history(spark, folder + "-none")
    with pytest.raises(C.ConfigError, match="expired"):
        tables.read_history(spark, folder, as_of=1)


def test_batches_without_rows_change_nothing(spark, rows, folder):
    none = batch(spark, (1, "a", D1, "A")).limit(0)
    assert tables.commit_history(spark, folder, none, CFG, D1) == -1 and tables.versions(spark, folder) == []
    tables.commit_history(spark, folder, batch(spark, (1, "a", D1, "A")), CFG, D1)
    assert tables.commit_history(spark, folder, none, CFG, D2) == 0
    assert short(rows, tables.read_history(spark, folder)) == [(1, "a", None, 1, 0)]
    path = folder + "-append"
    tables.upsert_append(spark, path, H.history_rows(none, D1), CFG)
    assert not tables.has_rows(spark, path)
    with pytest.raises(C.ConfigError):
        tables.read_append(spark, path)
    assert tables.read_append(spark, path, H.history_rows(none, D1).schema).count() == 0


def test_columns_that_come_later_are_kept(spark, rows, folder):
    tables.upsert_append(spark, folder, H.history_rows(batch(spark, (1, "a", D1, "A")), D1), CFG)
    tables.upsert_append(spark, folder, H.history_rows(batch(spark, (2, "b", D2, "A")).withColumn("w", F.lit("x")), D2), CFG)
    assert rows(tables.read_append(spark, folder), "k", "w") == [(1, None), (2, "x")]


def test_unfinished_commit_is_ignored(spark, rows, folder):
    tables.commit_history(spark, folder, batch(spark, (1, "a", D1, "A")), CFG, D1)
    torn = batch(spark, (1, "torn", D2, "A")).withColumn(H.CURRENT, F.lit(1))
    torn.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(H.CURRENT).parquet(f"{folder}/{tables.VERSION}=1")
    assert short(rows, tables.read_history(spark, folder)) == [(1, "a", None, 1, 0)]
    tables.commit_history(spark, folder, batch(spark, (1, "b", D2, "A")), CFG, D2)
    assert short(rows, tables.read_history(spark, folder)) == [(1, "a", D2, 0, 0), (1, "b", None, 1, 0)]


# ---- upserts ---------------------------------------------------------------------


def loaded(spark, *cells):
    return spark.createDataFrame([(k, v, n, dt.date.fromisoformat(d) if d else None) for k, v, n, d in cells], "k int, v string, n int, dt date")


def test_upsert_scopes(spark, rows):
    old = loaded(spark, (1, "a", 5, D1), (2, "b", 5, D1))
    new = loaded(spark, (1, "a2", 1, D1), (1, "a1", 0, D1), (2, "b2", 9, D2), (None, "z", 1, D1))
    by_date = H.upsert(old, new, ["k"], ["n"])
    assert rows(by_date, "k", "v", "dt") == [
        (1, "a2", dt.date(2024, 1, 1)),
        (2, "b", dt.date(2024, 1, 1)),
        (2, "b2", dt.date(2024, 1, 2)),
        (None, "z", dt.date(2024, 1, 1)),
    ]
    assert rows(H.upsert(old, new, ["k"], ["n"], "table"), "k", "v") == [(1, "a2"), (2, "b2"), (None, "z")]
    greater = H.upsert(old, new, ["k"], ["n"], "table", compare_stored=True)
    assert rows(greater, "k", "v") == [(1, "a"), (2, "b2"), (None, "z")]
    assert rows(H.upsert(by_date, new, ["k"], ["n"])) == rows(by_date)
    with pytest.raises(C.ConfigError):
        H.upsert(old, new, ["k"], ["n"], "row")


def test_stored_upsert_leaves_other_dates_alone(spark, rows, folder):
    cfg = HistoryConfig("t", ("k",), "n")
    tables.upsert_append(spark, folder, loaded(spark, (1, "a", 1, D1), (2, "b", 1, D2), (7, "n", 1, None)), cfg)
    of_day1 = lambda: {f for f in spark.read.parquet(folder).inputFiles() if f"dt={D1}" in f}
    untouched = of_day1()
    tables.upsert_append(spark, folder, loaded(spark, (2, "b2", 2, D2), (3, "c", 2, D2), (7, "n2", 2, None)), cfg)
    stored = spark.read.parquet(folder)
    assert rows(stored, "k", "v") == [(1, "a"), (2, "b2"), (3, "c"), (7, "n2")]
    assert untouched and of_day1() == untouched


def test_history_rows(spark):
    df = spark.createDataFrame([(1, "x")], ["A B", "DataQualityEvaluationResult"])
    assert H.history_rows(df, D1).columns == ["a_b", "dt"]
    with pytest.raises(C.ConfigError):
        H.history_rows(df, stamp=False)
    assert H.history_rows(df.withColumn("DT", F.lit(D1)), stamp=False).columns == ["a_b", "dt"]


# ---- pivots ----------------------------------------------------------------------


def test_pivot_cells(spark, rows):
    df = spark.createDataFrame([(1, "a", 10), (1, "b", 20), (2, "a", 30), (2, None, 40), (3, "c", 50)], "g int, p string, v int")
    given = transpose(df, TransposeConfig(("g",), "p", "v", pivot_values=("a", "b")))
    assert rows(given, "g", "a", "b") == [(1, 10, 20), (2, 30, None), (3, None, None)]
    found = transpose(df, TransposeConfig(("g",), "p", "v"))
    assert found.columns == ["g", "null", "a", "b", "c"]
    with pytest.raises(C.ConfigError):
        transpose(df, TransposeConfig(("g",), "missing", "v"))
    with pytest.raises(C.ConfigError):
        transpose(df, TransposeConfig(("g",), "p", "v", select=("g", "p")))


def test_pivot_takes_the_earliest(spark, rows):
    df = spark.createDataFrame([(1, "a", 2, "late"), (1, "a", 1, "early")], "g int, p string, o int, v string")
    assert rows(transpose(df, TransposeConfig(("g",), "p", "v", order_by=("o",))), "a") == [("early",)]


def test_named_histories(spark, rows, folder):
    from tallyfold.plans import batch as jobs
    from tallyfold.sources import catalog

    cfg = HistoryConfig("t", ("k",), "day", database="tallyfold_test")
    catalog.ensure_database(spark, "tallyfold_test", folder + "-db")
    for day, v in ((D1, "a"), (D2, "b")):
        jobs.load_history(spark, batch(spark, (1, v, day, "A")), cfg, folder + "/h", day)
        jobs.load_history(spark, batch(spark, (1, v, day, "A")), cfg, folder + "/a", day, "append")
    assert short(rows, catalog.read_table(spark, "tallyfold_test", "history_t")) == [(1, "a", D2, 0, 0), (1, "b", None, 1, 0)]
    assert rows(catalog.read_table(spark, "tallyfold_test", "append_t"), "k", "v") == [(1, "a"), (1, "b")]
    with pytest.raises(C.ConfigError):
        jobs.load_history(spark, batch(spark, (1, "c", D3, "A")), cfg, folder + "/h", D3, "other")


def test_a_lost_writer_loses_no_row(spark, rows, folder):
    cfg = HistoryConfig("t", ("k",), "n")
    load = lambda *cells: loaded(spark, *cells)
    tables.upsert_append(spark, folder, load((1, "a", 1, D1), (2, "b", 1, D2)), cfg)
    shown = lambda: rows(tables.read_append(spark, folder), "k", "v", H.LOADED)
    before = shown()
    # written aside without its marker: does not count
    torn = load((9, "torn", 2, D1))
    quiet = torn.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    quiet.partitionBy(H.LOADED).parquet(f"{folder}/{tables.STAGED}/torn")
    assert shown() == before
    # written, but only one of two dates was moved before the writer was lost
    staged = load((1, "a2", 2, D1), (3, "c", 2, D3))
    staged.write.partitionBy(H.LOADED).parquet(f"{folder}/{tables.STAGED}/x")
    after = [r for r in before if r[0] != 1] + [(r.k, r.v, r[H.LOADED]) for r in staged.collect()]
    assert shown() == sorted(after, key=repr)
    fs, old = tables._folder(spark, f"{folder}/{H.LOADED}={D1}")
    fs.delete(old, True)
    assert shown() == sorted(after, key=repr)
    tables.upsert_append(spark, folder, load((4, "d", 3, D3)), cfg)
    assert [r[:2] for r in shown()] == [(1, "a2"), (2, "b"), (3, "c"), (4, "d")]
    assert tables._staged(spark, folder) == []
