"""Substring removal against SQL and a plain version."""

import random
import re

import pytest
from check import compare, connect

from tallyfold.llm import queries, substrings


def _plain(docs, k):
    """Number of words, of removed ones and what is kept, by row."""
    split = [(float("inf") if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in split:
        for p in range(len(w) - k + 1):
            seen = tuple(w[p : p + k])
            first[seen] = min(i, first.get(seen, i))
    out = []
    for (key, _), (i, w) in zip(docs, split):
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone.update(range(p, p + k))
        out.append((key, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def _corpus(seed):
    """Passages shared in part, copies, loops, texts of few different words, and odd rows."""
    rng = random.Random(seed)
    passages = [[f"p{n}w{i}" for i in range(rng.randint(3, 60))] for n in range(6)]
    docs = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            words += p[a : rng.choice([len(p), len(p), rng.randint(a, len(p))])]
            words += [f"x{rng.randrange(40)}" for _ in range(rng.choice([0, 0, 1, 4]))]
        docs.append((i * 3, rng.choice([" ", "\n", " \t"]).join(words)))
    docs += [(400 + i, "a " * n) for i, n in enumerate((4, 5, 6, 30, 31))]
    docs += [(500 + i, "a b " * 20 + f"c{i} " + "b a " * 20) for i in range(3)]
    docs += [(600, docs[3][1]), (601, docs[3][1]), (601, docs[5][1]), (601, docs[3][1]), (1, docs[7][1]), (None, docs[9][1])]
    docs += [(None, " ".join(passages[0] * 3)), (700, None), (701, ""), (702, " \n "), (703, "nur wörter von 漢字 hier"), (704, "nur wörter von 漢字 hier")]
    return docs


@pytest.mark.parametrize("k, seed, slice_size", [(5, 1, 1 << 22), (5, 2, 300), (8, 3, 5000), (13, 4, 1 << 22), (1, 5, 1 << 22)])
def test_what_is_kept_is_what_a_plain_version_keeps(spark, monkeypatch, k, seed, slice_size):
    monkeypatch.setattr(substrings, "SLICE", slice_size)
    docs = _corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup(df, k=k, anchor=3).collect()]
    assert sorted(got, key=str) == _plain(docs, k)


def test_spans_joined_in_a_shuffle_and_full_tables_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SENT_SPANS", 0)
    monkeypatch.setattr(substrings, "TABLE_BITS", 1 << 15)
    monkeypatch.setattr(substrings, "has_bit", lambda table, ids: ids == ids)
    docs = _corpus(8)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.dedup(df, k=6).collect()]
    assert sorted(got, key=str) == _plain(docs, 6)


def test_runs_without_branches_become_one_path(spark):
    passage = " ".join(f"w{i}" for i in range(50))
    docs = [(i, f"before{i} {passage} behind{i}") for i in range(4)]
    rows = substrings._text_rows(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    table = substrings.repeated_anchors(rows, 13, 6)
    found = sorted((r.length, r.key, r.place & 0xFFFF) for r in substrings.paths(substrings.edges(rows, table, 13, 6)).collect())
    # the first and the last window have different words beside them
    assert found == [(1, 0, 1), (1, 0, 38), (36, 0, 2)]


def test_a_span_that_differs_from_its_source_is_kept(spark, monkeypatch):
    monkeypatch.setattr(substrings, "windows", lambda words, k: (s := _windows(words, k))[0:1] + (s[1] * 0 + s[0].astype("uint64"),))
    docs = [(1, "a b c d e f"), (2, "a b c x y z")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert all(r.n_removed == 0 for r in substrings.dedup(df, k=4, anchor=2).collect())


_windows = substrings.windows


def test_a_very_long_text(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600_000)]
    docs = [(1, " ".join(words)), (2, "new " + " ".join(words[1000:-1000]) + " end"), (3, "y" * 5_000_000)]
    got = {r.doc_id: r for r in substrings.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].kept, got[3].n_words) == (0, 598_000, "new end", 1)


def test_odd_rows_and_empty_tables(odd_docs):
    out = substrings.dedup(odd_docs.withColumn("kept", odd_docs["n"]).withColumn("key", odd_docs["n"]))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "n", "key", "n_words", "n_removed", "kept"]
    assert {(r.doc_id, r.n_removed) for r in out.collect() if r.doc_id in (1, 7)} == {(1, 0), (7, 0)}
    assert {(r.doc_id, r.n_removed) for r in substrings.dedup(odd_docs, k=11).collect() if r.n_removed} == {(7, 11)}
    assert substrings.dedup(odd_docs.limit(0)).count() == 0


def test_query_agrees_with_its_sql(spark, sf_dir):
    name = "op13_substrings"
    assert compare(spark, connect(sf_dir), sf_dir, name, queries.QUERIES[name], queries.ORACLE[name]) == ""
