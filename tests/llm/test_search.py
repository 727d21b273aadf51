"""Near duplicates, decontamination and top-k search against brute force."""

import itertools
import random

import numpy as np
import pytest
from check import compare, connect

from tallyfold.llm import components, decontaminate, ngram_join, queries, topk


def _shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def _brute(docs, threshold=0.8):
    """Class and number of linked different sets of each document, in plain Python."""
    sets = {i: frozenset(_shingles(t)) for i, t in docs}
    distinct = sorted({s for s in sets.values() if s}, key=lambda s: min(i for i in sets if sets[i] == s))
    near = {s: set() for s in distinct}
    for a, b in itertools.combinations(distinct, 2):
        if len(a & b) >= threshold * len(a | b) - 1e-12:
            near[a].add(b)
            near[b].add(a)
    root = {}
    for s in distinct:
        if s not in root:
            todo = [s]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = s
                    todo += near[x]
    first = {}
    for i, s in sets.items():
        if s:
            first[root[s]] = min(i, first.get(root[s], i))
    return {i: (first[root[s]] if s else i, len(near[s]) if s else 0) for i, s in sets.items()}


def test_join_finds_what_brute_force_finds(spark, sf_dir, tables):
    docs = [(r.doc_id, r.text) for r in tables("documents").select("doc_id", "text").collect()]
    want = _brute(docs)
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op8_ngram_join(spark, sf_dir).collect()}
    assert got == want


def test_large_groups_are_compared_in_tiles(spark):
    """More near copies than a block holds, all linked with each other, and a chain besides."""
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join([*base[:118], f"a{i}", f"b{i}"])) for i in range(2 * ngram_join.BLOCK + 40)]
    chain = [(1000 + i, " ".join(f"c{j}" for j in range(9 * i, 9 * i + 120))) for i in range(6)]
    df = spark.createDataFrame(docs + chain, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(df).collect()}
    assert all(got[i] == (0, len(docs) - 1) for i, _ in docs)
    assert [got[i] for i, _ in chain] == [_brute(chain)[i] for i, _ in chain]


def test_join_of_odd_rows(spark, odd_docs):
    out = ngram_join.join(odd_docs).collect()
    assert len(out) == odd_docs.count()
    got = {r.doc_id: r for r in out}
    assert got[2].class_id == 2 and got[3].n_links == 0 and got[4].n_copies == 0
    assert [(r.class_id, r.n_copies) for r in out if r.doc_id == 1] == [(1, 1), (1, 1)]
    assert got[7].class_id == 1 and got[7].n_links == 1
    assert got[None].class_id is None
    assert ngram_join.join(odd_docs.limit(0)).count() == 0


def test_keep_one_keeps_rows_without_words_and_the_least_of_a_group(odd_docs):
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 6, 8, 9, None], key=str)


def test_bands_reach_the_recall_asked_for():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.99), (1.0, 0.9)):
        bands, rows = ngram_join.bands_for(threshold, recall, 144)
        assert 1 - (1 - threshold**rows) ** bands >= recall - 1e-12 and bands * rows <= 144
    with pytest.raises(ValueError):
        ngram_join.bands_for(0.1, 0.9999, 8)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 9)] + [(200, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.connected(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)}


def test_decontamination_agrees_with_its_sql(spark, sf_dir):
    name = "op6_decontaminate"
    assert compare(spark, connect(sf_dir), sf_dir, name, queries.QUERIES[name], queries.ORACLE[name]) == ""


def test_decontamination_runs_no_python(spark, sf_dir):
    plan = queries.op6_decontaminate(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "InMap"))


def test_substituted_words_are_tolerated(spark):
    item = [f"t{i}" for i in range(40)]
    near = [x if i % 9 else f"other{i}" for i, x in enumerate(item)]
    far = [x if i % 2 else f"other{i}" for i, x in enumerate(item)]
    texts = [(1, "before " + " ".join(item) + " behind"), (2, "A, b: " + " ".join(near).upper()), (3, " ".join(far)), (4, None), (5, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (None, "too short"), (8, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(1, 7), (2, 7)}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()) == [3, 4, 5]
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_every_token_around_a_hit_is_compared(spark):
    rng = random.Random(6)
    items, texts, want = {}, [], set()
    seeds = [[i for i, x in enumerate(seed) if x == "1"] for seed in (*decontaminate.SEEDS, decontaminate.FIFTH)]
    for n in range(120):
        size = rng.choice((15, 20, 25, 30))
        other = set(range(n % 5, size, 5)) if n < 20 else set(rng.sample(range(size), rng.randint(2, size // 2)))
        items[n] = [f"w{n}x{i}" for i in range(size)]
        passage = [f"other{n}y{i}" if i in other else x for i, x in enumerate(items[n])]
        texts.append((n, " ".join(["before"] * (n % 7) + passage + ["behind"] * (n % 3))))
        hit = any(all(at + i not in other for i in seed) for seed in seeds for at in range(size - 9))
        need = -(-min(size, 20) * 60 // 100)
        if hit and any(sum(i not in other for i in range(at, min(at + 20, size))) >= need for at in range(max(1, size - 19))):
            want.add((n, n, 1, size - len(other)))
    assert {(n, n, 1) for n in range(20)} <= {w[:3] for w in want} and len(want) < 110
    docs = spark.createDataFrame(texts * 2, "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.leaks(docs, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()} == set(items) - {w[0] for w in want}


def test_a_benchmark_in_parts_finds_the_same(spark, sf_dir, tables, monkeypatch):
    whole = decontaminate.leaks(tables("documents"), tables("benchmark")).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 2000)
    parts = decontaminate.leaks(tables("documents"), tables("benchmark")).collect()
    assert sorted(whole) == sorted(parts) and whole


def test_decontamination_of_odd_rows(odd_docs):
    bench = odd_docs.where("doc_id = 7").selectExpr("n as item_id", "text")
    left = decontaminate.drop_leaks(odd_docs, bench)
    assert left.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["2", "3", "4", "None", "5", "6", "8", "9"])


def _brute_top(rows, k, every):
    out = []
    for a, (i, x) in enumerate(rows):
        if i is None or x is None or i % every:
            continue
        found = sorted((-int(np.dot(x, y)), j) for b, (j, y) in enumerate(rows) if b != a and j is not None and y is not None)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_is_exact(spark, sf_dir, tables):
    rows = [(r.vec_id, np.floor(64 * np.array(r.embedding)).astype(int)) for r in tables("embeddings").collect()]
    got = sorted(tuple(r) for r in queries.op9_topk(spark, sf_dir).collect())
    assert got == _brute_top(rows, 20, 20)


def test_top_k_of_odd_rows(spark):
    nan = float("nan")
    vectors = [(i, [float(i % 5), 1.0, -0.5]) for i in range(60)]
    vectors += [(60, None), (80, [1.0, None, 2.0]), (100, [nan, 1.0, 1.0]), (120, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (0, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    ok = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in vectors if v and None not in v and np.isfinite(v).all()]
    got = sorted(tuple(r) for r in topk.top(df, k=7).collect())
    assert got == _brute_top(ok, 7, 20)
    assert topk.top(df.limit(0)).count() == 0
    assert topk.top(df.where("vec_id = 20")).count() == 0


def _leaks(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r)[:2] for r in decontaminate.leaks(docs, bench).collect()}
    left = {r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()}
    assert left == {d for d, _ in docs.collect()} - {d for d, _ in found}
    return found


def test_short_items_and_scripts_without_spaces_are_exact(spark):
    items = [(1, "one two three four five six"), (2, "a b c d"), (3, "この文章は評価用の問題文であり漏れてはならない"), (4, "五文字です")]
    docs = [
        (1, "x, One two-three four FIVE six. y"),
        (2, "one two three four other five six"),
        (3, "a b c d a b c d"),
        (4, "前置き。この文章は評価用の問題文であり漏れてはならない。後"),
        (5, "この文章は別のもので関係がありません"),
        (6, "これは五文字です。"),
    ]
    assert _leaks(spark, docs, items) == {(1, 1), (4, 3), (6, 4)}


def test_a_very_long_text_is_cut_into_chunks(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(30))
    for at in (4090, 8180):
        long = " ".join(f"w{i}" for i in range(at)) + " " + passage + " " + " ".join(f"v{i}" for i in range(9000))
        assert _leaks(spark, [(1, long), (2, "w1 w2 w3")], [(7, passage)]) == {(1, 7)}


def test_a_shared_instruction_is_compared_once_for_each_document(spark, monkeypatch):
    shared = " ".join(f"s{i}" for i in range(13))
    n = 300
    docs = spark.createDataFrame([(i, f"{shared} " + " ".join(f"d{i}x{j}" for j in range(20))) for i in range(n)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, f"{shared} " + " ".join(f"b{i}x{j}" for j in range(20))) for i in range(n)], "item_id long, text string")
    seen = []
    real = decontaminate._diagonals
    monkeypatch.setattr(decontaminate, "_diagonals", lambda hits: (out := real(hits), seen.append(out.count()))[0])
    assert decontaminate.drop_leaks(docs, bench).count() == 0
    assert sum(seen) <= 4 * n
    assert decontaminate.leaks(docs, bench.limit(2)).count() == 2 * n


def test_blocks_that_cannot_win_are_not_brought_together(spark, monkeypatch):
    """Clusters far apart: a query block meets the candidates of its own cluster alone, and the result is whole."""
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(0, 0.05, 8)).tolist()) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    kept = []
    real = topk.meeting
    monkeypatch.setattr(topk, "meeting", lambda c, q: (out := real(c, q), kept.append((out.count(), c.select("block").distinct().count() * q.select("block").distinct().count())))[0])
    got = sorted(tuple(r) for r in topk.top(df, k=5).collect())
    assert got == _brute_top([(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows], 5, 20)
    met, pairs = kept[0]
    assert met < pairs / 3


def test_numbers_beyond_64_bits_are_the_largest(spark):
    import pyarrow as pa

    column = pa.array([[1e30, -1e30, 0.5], [2.0**57, -(2.0**57), -0.01], None, [None, 1.0], [float("nan")], [], [float("inf")]])
    got = [None if v is None else np.frombuffer(v, np.int64).tolist() for v in topk.scaled(column, 64.0).to_pylist()]
    top = 2**63 - 1
    assert got == [[top, -top - 1, 32], [top, -top - 1, -1], None, None, None, [], None]
    assert topk.scaled(column.slice(1, 2), 64.0).to_pylist()[1] is None
