"""Ranked lexical search against SQL and a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from check import compare, connect

from tallyfold.llm import lexical, queries


def _terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _plain(docs, items, k):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(_terms(text))
                if c[t]
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def test_query_agrees_with_its_sql(spark, sf_dir):
    name = "op12_lexical"
    assert compare(spark, connect(sf_dir), sf_dir, name, queries.QUERIES[name], queries.ORACLE[name]) == ""


@pytest.mark.parametrize("sizes", [(32, 4096, 200_000), (2, 7, 40)])
def test_the_best_are_those_of_a_plain_version(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "SHARD", "PASS"), sizes, strict=True):
        monkeypatch.setattr(lexical, name, value)
    monkeypatch.setattr(lexical, "PAIRS", 50 if sizes[0] == 2 else 1 << 21)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)] + ["Äpfel", "äpfel", "漢字", "X9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(150)]
    docs += [(200 + i, "w1 w1 w50") for i in range(25)] + [(7, "w50"), (None, "w51 w1"), (None, "w51 w1"), (300, None), (301, ""), (302, "-- !")]
    docs += [(303, "w3 w50 " * 4000)]
    items = [(i, text(rng.randint(1, 12))) for i in range(20)] + [(50, "w50 W1"), (51, "w51"), (52, None), (53, "?"), (54, "unseen"), (None, "w9")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    got = sorted((tuple(r) for r in lexical.search(df, bench, k=6).collect()), key=str)
    assert got == _plain(docs, items, 6)


def test_blocks_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(4)
    n, v = 600, 40
    has = rng.random((n, v)) < np.linspace(0.02, 0.7, v)
    values = np.where(has, rng.integers(1, 1000, (n, v)), 0)
    weights = np.sort(rng.integers(1, 900, v))[::-1].copy()
    items = [np.sort(rng.choice(v, 8, replace=False)) for _ in range(12)]
    q = lexical.Queries(np.arange(12), items, weights, np.arange(v), n, 1000)
    of, terms = np.nonzero(has)
    ptr = np.concatenate([[0], np.cumsum(has.sum(1))])
    shard = lexical.Shard(q, np.arange(n), ptr, terms, values[of, terms])
    assert np.diff(shard.block_ptr).max() <= lexical.BLOCK
    scored = 0
    for t in items:
        w = np.zeros(v, np.int64)
        w[t] = weights[t]
        whole = values @ w
        for x in t:
            bounds = shard.bounds(w, x)
            for at, b in enumerate(range(shard.list_of[x], shard.list_of[x + 1])):
                docs = shard.docs[shard.block_ptr[b] : shard.block_ptr[b + 1]]
                assert has[docs, x].all()
                lighter = np.where(np.arange(v) >= x, w, 0)
                assert (values[docs] @ lighter <= bounds[at]).all()
        best = lexical.Best(5)
        scored += shard.search(t, w, best)
        want = sorted(zip(-whole, range(n)))[:5]
        assert list(zip(-best.scores, best.ids)) == want
    assert scored < 0.6 * 12 * n


def test_odd_rows_and_empty_tables(odd_docs):
    bench = odd_docs.where("doc_id = 7").selectExpr("n as item_id", "text", "lang as score")
    got = lexical.search(odd_docs, bench)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [7, 1, 1]
    assert lexical.search(odd_docs.limit(0), bench).count() == 0
    assert lexical.search(odd_docs, bench.limit(0)).count() == 0
