"""Several writers of one table at once."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest

from tallyfold.config import HistoryConfig
from tallyfold.operators import history as H
from tallyfold.sources import commits, tables

CFG = HistoryConfig("t", ("k",), "n")
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def at_once(n, work):
    with ThreadPoolExecutor(n) as pool:
        return list(pool.map(work, range(n)))


def test_only_one_gets_a_name(spark, folder):
    for i in range(6):
        commits.mark(spark, f"{folder}/source{i}", "x")
    got = at_once(6, lambda i: commits.claim(spark, f"{folder}/source{i}", f"{folder}/target"))
    assert sum(got) == 1 and commits.children(spark, f"{folder}/target") == ["x"]
    assert not commits.claim(spark, f"{folder}/gone", f"{folder}/other")


def test_upserts_of_several_writers_lose_no_row(spark, rows, folder):
    def work(i):
        cells = [(100 * i + j, i, DAYS[j % 2]) for j in range(4)] + [(7, i, DAYS[0])]
        tables.upsert_append(spark, folder, spark.createDataFrame(cells, "k int, n int, dt date"), CFG, compare_stored=True)

    at_once(4, work)
    want = {(100 * i + j, i, DAYS[j % 2]) for i in range(4) for j in range(4)} | {(7, 3, DAYS[0])}
    assert rows(tables.read_append(spark, folder), "k", "n", "dt") == sorted(want, key=repr)
    assert rows(spark.read.parquet(folder), "k", "n", "dt") == sorted(want, key=repr)
    assert tables._latest(spark, folder) == 4 and tables._staged(spark, folder) == []


def test_commits_of_several_writers_follow_one_another(spark, rows, folder):
    cfg = HistoryConfig("t", ("k",), "day")

    def work(i):
        cells = [(100 * i + j, f"2024-01-0{i + 1}") for j in range(3)]
        return tables.commit_history(spark, folder, spark.createDataFrame(cells, "k int, day string"), cfg, DAYS[0])

    assert sorted(at_once(4, work)) == [0, 1, 2, 3] == tables.versions(spark, folder)
    found = rows(tables.read_history(spark, folder), "k", H.CURRENT)
    assert found == sorted(((100 * i + j, 1) for i in range(4) for j in range(3)), key=repr)


def test_a_writer_that_read_an_old_state_starts_again(spark, rows, folder, monkeypatch):
    """Another writer commits between the reading and the claim of the first."""
    real, done = commits.new_aside, []

    def slow(path):
        if not done:
            done.append(1)
            aside = real(path)
            tables.upsert_append(spark, folder, spark.createDataFrame([(2, 1, DAYS[0])], "k int, n int, dt date"), CFG)
            return aside
        return real(path)

    monkeypatch.setattr(commits, "new_aside", slow)
    tables.upsert_append(spark, folder, spark.createDataFrame([(1, 1, DAYS[0])], "k int, n int, dt date"), CFG)
    assert rows(tables.read_append(spark, folder), "k") == [(1,), (2,)]


def test_endless_conflicts_end(spark, folder, monkeypatch):
    monkeypatch.setattr(commits, "ATTEMPTS", 2)
    monkeypatch.setattr(commits, "claim", lambda *a: False)
    with pytest.raises(commits.ConflictError):
        tables.commit_history(spark, folder, spark.createDataFrame([(1, "2024-01-01")], "k int, day string"), HistoryConfig("t", ("k",), "day"))
