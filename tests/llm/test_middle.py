"""Fill-in-the-middle forms against a plain version and SQL."""

import hashlib
import random
import re

import pytest
from check import compare, connect

from tallyfold.llm import middle, queries


def _plain(key, text, seed, rate, spm):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    d = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return n, "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def _odd_texts():
    rng = random.Random(3)
    out = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a<P>b\nc", "<M>", "<", "<S\n<P\n<", "ä\nö ü\n漢字\n😀", "\r\n\x0b\x85 x", "x" * 300_000, "l\n" * 50_000]
    return out + ["".join(rng.choice("ab<PSM>\n\n é") for _ in range(rng.randint(0, 60))) for _ in range(300)]


@pytest.mark.parametrize("rate, spm", [(100, 50), (60, 100), (0, 50), (100, 0)])
def test_forms_are_those_of_a_plain_version(spark, monkeypatch, rate, spm):
    monkeypatch.setattr(middle, "SLICE", 1000)
    texts = list(enumerate(_odd_texts())) + [(None, "a\nb\nc\n"), (3, "a\nb\nc\n"), (3, "a\nb\nc\n")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    out = middle.restore(middle.transform(df, seed=11, rate=rate, spm=spm)).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) == _plain(r.doc_id, r.text, 11, rate, spm)
        assert r.restored == (r.text or "")


def test_columns_with_clashing_names_and_empty_tables(odd_docs):
    out = middle.transform(odd_docs.withColumn("form", odd_docs["lang"]).withColumn("output", odd_docs["n"]))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "n", "form", "output", "prefix_chars", "middle_chars"]
    assert {r.form for r in out.collect()} <= {"plain", "psm", "spm"} and out.count() == odd_docs.count()
    assert middle.restore(middle.transform(odd_docs.limit(0))).count() == 0
    again = middle.restore(out.withColumn("restored", out["n"]))
    assert all(r.restored == (r.text or "") for r in again.collect())


def test_query_agrees_with_its_sql(spark, sf_dir):
    name = "op11_middle"
    assert compare(spark, connect(sf_dir), sf_dir, name, queries.QUERIES[name], queries.ORACLE[name]) == ""
