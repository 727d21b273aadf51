"""Batches that come late: rows are placed by their dates, not by their arrival."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyfold import config as C
from tallyfold.config import HistoryConfig
from tallyfold.operators import history as H
from tallyfold.sources import catalog, tables

CFG = HistoryConfig("t", ("k",), "day", tie_breakers=("v",))
DAYS = [f"2024-01-0{i}" for i in range(1, 8)]


def batch(spark, cells):
    return spark.createDataFrame(list(cells), "k int, v string, day string")


def short(df):
    rows = df.select("k", "v", H.START, H.END, H.CURRENT).collect()
    text = lambda d: None if d is None or d == H.OPEN_END else str(d)
    return sorted(((r[0], r[1], text(r[2]), text(r[3]), r[4]) for r in rows), key=str)


def plain(batches):
    """The history of all rows, sorted by key and day."""
    best = {}
    for k, v, day in itertools.chain(*batches):
        best[k, day] = max(v, best.get((k, day), v))
    out = []
    for k in {k for k, _ in best}:
        days = sorted(d for q, d in best if q == k)
        for d, end in zip(days, [*days[1:], None]):
            out.append((k, best[k, d], d, end, int(end is None)))
    return sorted(out, key=str)


CELLS = st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.sampled_from("ab"), st.sampled_from(DAYS))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(CELLS, min_size=1, max_size=4), min_size=1, max_size=4))
def test_the_order_of_arrival_does_not_matter(spark, batches):
    for order in (batches, batches[::-1]):
        history = None
        for b in order:
            history = H.merge(history, batch(spark, b), CFG, DAYS[0], out_of_order=True)
        assert short(history) == plain(batches)


ARRIVALS = [
    [(1, "c", DAYS[4]), (2, "x", DAYS[0]), (None, "n", DAYS[3])],
    [(1, "a", DAYS[0]), (1, "b", DAYS[2])],
    [(1, "bb", DAYS[3]), (None, "m", DAYS[1]), (3, "new", DAYS[5])],
    [(1, "b", DAYS[2]), (2, "y", DAYS[6])],
]


def test_stored_histories_take_late_batches(spark, folder):
    for n, b in enumerate(ARRIVALS):
        assert tables.commit_history(spark, folder, batch(spark, b), CFG, DAYS[n], out_of_order=True) == n
        assert short(tables.read_history(spark, folder)) == plain(ARRIVALS[: n + 1])
    for n in range(len(ARRIVALS)):
        assert short(tables.read_history(spark, folder, as_of=n)) == plain(ARRIVALS[: n + 1])
    catalog.ensure_database(spark, "tallyfold_late", folder + "-db")
    catalog.publish_history(spark, "tallyfold_late", "late", folder)
    assert short(catalog.read_table(spark, "tallyfold_late", "late")) == plain(ARRIVALS)
    # a batch in order goes on from there
    tables.commit_history(spark, folder, batch(spark, [(3, "end", DAYS[6])]), CFG, DAYS[6])
    assert short(tables.read_history(spark, folder)) == plain([*ARRIVALS, [(3, "end", DAYS[6])]])


def test_closed_rows_are_written_again_only_if_they_change(spark, folder):
    for n, b in enumerate(ARRIVALS[:3]):
        tables.commit_history(spark, folder, batch(spark, b), CFG, DAYS[n], out_of_order=True)
    third = spark.read.parquet(f"{folder}/{tables.VERSION}=2/{H.CURRENT}=0")
    assert sorted((r.k or 0, r.v) for r in third.collect()) == [(0, "m"), (1, "b"), (1, "bb")]
    gone = tables.superseded(spark, folder, [0, 1, 2]).collect()
    assert [(r.k, str(r[H.START])) for r in gone] == [(1, DAYS[2])]
    again = tables.commit_history(spark, folder, batch(spark, ARRIVALS[2]), CFG, DAYS[2], out_of_order=True)
    assert again == 3 and short(tables.read_history(spark, folder)) == plain(ARRIVALS[:3])


def test_load_dates_tell_the_last_change(spark):
    first = H.merge(None, batch(spark, [(1, "b", DAYS[2])]), CFG, DAYS[5], out_of_order=True)
    then = H.merge(first, batch(spark, [(1, "a", DAYS[0])]), CFG, DAYS[6], out_of_order=True)
    assert sorted((r.v, str(r.dt)) for r in then.collect()) == [("a", DAYS[6]), ("b", DAYS[5])]
    then = H.merge(then, batch(spark, [(1, "c", DAYS[3])]), CFG, DAYS[1], out_of_order=True)
    assert sorted((r.v, str(r.dt)) for r in then.collect()) == [("a", DAYS[6]), ("b", DAYS[1]), ("c", DAYS[1])]
    with pytest.raises(C.ConfigError):
        H.merge(then, batch(spark, [(1, "c", DAYS[3])]), CFG, DAYS[1], out_of_order=True, close_on="open")
    unparsed = H.merge(None, batch(spark, [(1, "c", DAYS[3]), (1, "z", "bad")]), CFG, DAYS[1], out_of_order=True)
    assert [(r.v, r[H.CURRENT], str(r[H.END])) for r in unparsed.orderBy("v").collect()][1] == ("z", 0, DAYS[3])
    assert unparsed.where(F.col(H.CURRENT) == 1).count() == 1
