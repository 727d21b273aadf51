"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A text is the list of its lower-cased runs of letters and digits; characters of
scripts that are written without spaces are tokens of their own. A seed looks at
some positions of a window of tokens and ignores the others, so that windows that
differ in ignored positions hash alike. The hashes of all windows of all documents
are joined with those of the benchmark. The hits of a document and an item on one
diagonal (the distance between their windows) are put together, and the tokens of
both from `reach` before the first hit to `reach` behind the last are compared one
by one. The overlap holds if so many equal ones lie within `reach` tokens that
they are `share` percent of those, or of the whole item if it is shorter.
Substituted words in between do not count.

Items shorter than the seeds are found if all their tokens stand in a document
one after the other; items of fewer than `shortest` tokens, which would stand
anywhere, match nothing. Items of equal tokens are compared once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.inputs import sent
from tallyfold.session import materialise

#: 1 for positions that are hashed, 0 for ignored ones; all of one length.
SEEDS = ("1101100101", "1010011011")
#: Looks at no offset of 2 mod 5, so it hits though every fifth token is substituted; the others look at all residues.
FIFTH = "1101010011"
REACH = 20
SHARE = 60
#: Fewest tokens of an item that is looked for.
SHORTEST = 5
#: Windows that one row holds at a time, whatever the length of its text.
CHUNK = 4096
#: Scripts that are written without spaces, by the names Java and RE2 have for them.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
#: Windows, or tokens, of the benchmark that one broadcast holds, some 40 bytes each.
BROADCAST_ROWS = 1_000_000


def tokens(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    apart = "[" + "".join(rf"\p{{Is{script}}}" for script in UNSPACED) + "]"
    # all these scripts lie in one range, which is tested fast; few texts have anything there
    beyond = text.rlike(r"[\x{0E00}-\x{10FFFF}]")
    text = F.when(beyond, F.regexp_replace(text, f"({apart})", " $1 ")).otherwise(text)
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _windows(rows: DataFrame, seeds: Sequence[str]) -> DataFrame:
    """A row for each window and seed of the token hashes `h`, without them: `at` and `hash`.

    The tokens are dealt out in chunks, so that the windows of a long text are never in one row.
    """
    span = len(seeds[0])
    kept = [c for c in rows.columns if c != "h"]
    lows = F.sequence(F.lit(0), F.greatest(F.size("h") - span, F.lit(0)), F.lit(CHUNK))
    chunks = F.transform(lows, lambda i: F.struct(i.alias("_low"), F.slice("h", i + 1, F.lit(CHUNK + span - 1)).alias("_chunk")))
    whole = F.array(F.struct(F.lit(0).alias("_low"), F.col("h").alias("_chunk")))
    chunks = F.when(F.size("h") >= span, F.when(F.size("h") < CHUNK + span, whole).otherwise(chunks))
    # the outer forms, as filters before the others would split the texts a second time
    rows = rows.select(*kept, F.inline_outer(chunks))
    # positions are unfolded and hashed in compiled code, which a lambda over the tokens would not be
    rows = rows.select(*kept, "_low", "_chunk", F.explode_outer(F.sequence(F.lit(0), F.size("_chunk") - span)).alias("_at"))

    def hashed(s: int, seed: str) -> Column:
        return F.xxhash64(F.lit(s), *[F.get("_chunk", F.col("_at") + i) for i, used in enumerate(seed) if used == "1"])

    hashes = F.when(F.col("_at").isNotNull(), F.array(*[hashed(s, seed) for s, seed in enumerate(seeds)]))
    rows = rows.select(*kept, (F.col("_low") + F.col("_at")).alias("at"), hashes.alias("_hashes"))
    return rows.select(*kept, "at", F.explode_outer("_hashes").alias("hash"))


def _parts(stored: DataFrame, by: str, n: int) -> list[DataFrame]:
    """The table in parts by the hash of a column, each small enough to send if the table has n windows or tokens."""
    parts = max(1, -(-n // BROADCAST_ROWS))
    if parts == 1:
        return [stored]
    return [stored.where(F.pmod(F.xxhash64(by), F.lit(parts)) == part) for part in range(parts)]


def _hashed(text: Column) -> Column:
    return F.transform(tokens(text), lambda x: F.xxhash64(x))


def _proven(docs: DataFrame, kept: list[str], text: str, hits: DataFrame, whole: DataFrame, seeds: Sequence[str], reach: int, share: int) -> DataFrame:
    """(_doc, kept, _words, _shift, _matched) of the overlaps that hold.

    hits: (_doc, _words, _size, _shift, _first, _last), a row for each diagonal, stored; whole: (_words, _tokens).
    """
    span = len(seeds[0])
    # the texts that were hit are split into tokens a second time, each once
    hit = docs.join(sent(materialise(hits.select("_doc").distinct(), "benchmark-docs")), "_doc", "left_semi")
    hit = hit.select("_doc", *kept, _hashed(F.col(text)).alias("h")).join(sent(hits), "_doc")
    n_tokens = whole.agg(F.sum(F.size("_tokens"))).first()[0] or 0
    compared = [hit.join(F.broadcast(mine), "_words") for mine in _parts(whole, "_words", n_tokens)]
    shift = F.col("_shift")
    start = F.greatest(F.lit(0), -shift, F.col("_first") - reach)
    end = F.least(F.col("_size"), F.size("h") - shift, F.col("_last") + span + reach)
    equal = F.filter(F.sequence(start, end - 1), lambda i: F.get("_tokens", i) == F.get("h", i + shift))
    found = reduce(DataFrame.unionAll, compared).select("_doc", *kept, "_words", "_size", "_shift", equal.alias("_equal"))
    need = F.ceil(F.least(F.col("_size"), F.lit(reach)) * share / 100).cast("int")
    starts = F.sequence(F.lit(0), F.size("_equal") - need)
    close = F.exists(starts, lambda k: F.get("_equal", k + need - 1) - F.get("_equal", k) < reach)
    found = found.where((F.size("_equal") >= need) & close)
    return found.select("_doc", *kept, "_words", "_shift", F.size("_equal").alias("_matched")).distinct()


def _diagonals(hits: DataFrame) -> DataFrame:
    """Hits on one diagonal put together, stored."""
    found = hits.groupBy("_doc", "_size", "_words", (F.col("at") - F.col("_at")).alias("_shift"))
    return materialise(found.agg(F.min("_at").alias("_first"), F.max("_at").alias("_last")), "benchmark-hits")


def _short(docs: DataFrame, kept: list[str], text: str, short: DataFrame) -> DataFrame | None:
    """(kept, _words, _shift, _matched): where short items stand, token for token."""
    lengths = [r["_size"] for r in short.select("_size").distinct().collect()]
    rows = docs.select(*kept, _hashed(F.col(text)).alias("h"))
    found = []
    for n in sorted(lengths):
        runs = _windows(rows, ["1" * n]).select(*kept, "hash", F.col("at").alias("_shift"), F.lit(n).alias("_matched"))
        mine = short.where(F.col("_size") == n)
        mine = mine.select(F.xxhash64(F.lit(0), *[F.get("_tokens", F.lit(i)) for i in range(n)]).alias("hash"), "_words")
        mine = materialise(mine, "benchmark-short")
        found += [runs.join(F.broadcast(part), "hash") for part in _parts(mine, "hash", mine.count())]
    return reduce(DataFrame.unionAll, found).select(*kept, "_words", "_shift", "_matched") if found else None


def _items(benchmark: DataFrame, item: str, text: str, shortest: int) -> tuple[DataFrame, DataFrame]:
    """(_item, _words) of all items, and (_words, _size, _tokens) of the different ones, both stored."""
    items = benchmark.select(F.col(item).alias("_item"), _hashed(F.col(text)).alias("_tokens"))
    items = items.withColumn("_size", F.size("_tokens")).where(F.col("_size") >= shortest)
    items = items.withColumn("_words", F.xxhash64("_tokens"))
    whole = materialise(items.select("_words", "_size", "_tokens").dropDuplicates(["_words"]), "benchmark-tokens")
    return materialise(items.select("_item", "_words"), "benchmark-items"), whole


def _hits(docs: DataFrame, text: str, whole: DataFrame, seeds: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(_doc, at, hash): windows of documents that the benchmark has, and (hash, _words, _size, _at), both stored.

    The documents are read once, whatever the number of items with a window.
    """
    items = _windows(whole.select("_words", "_size", F.col("_tokens").alias("h")), seeds)
    items = items.where(F.col("hash").isNotNull()).select("hash", "_words", "_size", F.col("at").alias("_at"))
    items = materialise(items, "benchmark-seeds")
    known = materialise(items.select("hash").distinct(), "benchmark-hashes")
    rows = _windows(docs.select("_doc", _hashed(F.col(text)).alias("h")), seeds).select("_doc", "at", "hash")
    hits = [rows.join(F.broadcast(mine), "hash", "left_semi") for mine in _parts(known, "hash", known.count())]
    return materialise(reduce(DataFrame.unionAll, hits), "benchmark-windows"), items


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    seeds: Sequence[str] = (*SEEDS, FIFTH),
    reach: int = REACH,
    share: int = SHARE,
    shortest: int = SHORTEST,
) -> DataFrame:
    """The columns of docs but the text, with _item, _shift and _matched, for each overlap that holds.

    _shift is the diagonal, _matched the number of equal tokens compared on it.
    Equal rows of docs are one row here. The benchmark goes out in broadcasts of
    bounded size, over each of which the documents are read. Null texts have no
    tokens; a null item id is an id. There is a row for each document and item that
    overlap, so a passage of many of both makes many; `leaking` does not need them.
    """
    kept = [c for c in docs.columns if c != text]
    docs = docs.withColumn("_doc", F.xxhash64(*kept, text))
    items, whole = _items(benchmark, item, item_text, shortest)
    long = whole.where(F.col("_size") >= len(seeds[0]))
    hits, windows = _hits(docs, text, long, seeds)
    # both sides are small beside the texts, and a hash of many items is no more than what comes out
    found = _diagonals(hits.join(sent(windows), "hash"))
    found = _proven(docs, kept, text, found, long.select("_words", "_tokens"), seeds, reach, share).drop("_doc")
    short = _short(docs, kept, text, whole.where(F.col("_size") < len(seeds[0])))
    found = found.unionByName(short.distinct()) if short is not None else found
    return found.join(sent(items), "_words").drop("_words")


def leaking(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    seeds: Sequence[str] = (*SEEDS, FIFTH),
    reach: int = REACH,
    share: int = SHARE,
    shortest: int = SHORTEST,
) -> DataFrame:
    """The columns of docs but the text of the rows with an overlap, each once.

    One proof is enough. A window is first compared with one item that has it,
    the same for all documents, so a passage of many documents and many items is
    compared once for each document; only documents that this does not decide
    are compared with all items they hit.
    """
    kept = [c for c in docs.columns if c != text]
    docs = docs.withColumn("_doc", F.xxhash64(*kept, text))
    _, whole = _items(benchmark.withColumn("_none", F.lit(0)), "_none", item_text, shortest)
    long = whole.where(F.col("_size") >= len(seeds[0]))
    tokens_of = long.select("_words", "_tokens")
    hits, windows = _hits(docs, text, long, seeds)
    one = windows.groupBy("hash").agg(F.min(F.struct("_words", "_size", "_at")).alias("w")).select("hash", "w.*")
    first = _diagonals(hits.join(sent(materialise(one, "benchmark-first")), "hash"))
    proven = materialise(_proven(docs, kept, text, first, tokens_of, seeds, reach, share).select("_doc", *kept).distinct(), "leaks-first")
    rest = hits.join(sent(proven.select("_doc")), "_doc", "left_anti")
    rest = _diagonals(rest.join(sent(windows), "hash"))
    more = _proven(docs, kept, text, rest, tokens_of, seeds, reach, share)
    short = _short(docs, kept, text, whole.where(F.col("_size") < len(seeds[0])))
    found = proven.select(*kept).unionByName(more.select(*kept))
    return (found.unionByName(short.select(*kept)) if short is not None else found).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, item_id, n_overlaps, matched): documents and the items they hold, diagonals and most equal tokens on one."""
    rows = docs.select(key, F.xxhash64(text).alias("_hash"), text)
    found = overlaps(rows, benchmark, text).groupBy(key, F.col("_item").alias("item_id"))
    return found.agg(F.count("*").alias("n_overlaps"), F.max("_matched").alias("matched"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without an overlap; rows are told apart by key and text."""
    slim = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    found = sent(materialise(leaking(slim, benchmark, "_text"), "leaks"))
    same = docs[key].eqNullSafe(found["_key"]) & (F.xxhash64(docs[text]) == found["_hash"])
    return docs.join(found, same, "left_anti")


def sql(seeds: Sequence[str] = (*SEEDS, FIFTH), reach: int = REACH, share: int = SHARE, shortest: int = SHORTEST) -> str:
    """For DuckDB, the rows of `leaks` over documents and benchmark."""
    span = len(seeds[0])
    apart = "[" + "".join(rf"\p{{{script}}}" for script in UNSPACED) + "]"
    words = (
        rf"list_filter(regexp_split_to_array(lower(regexp_replace(coalesce(text, ''), '({apart})', ' \1 ', 'g')), "
        r"'[^\p{L}\p{N}]+'), lambda x: x <> '')"
    )

    def windows(table: str, key: str) -> str:
        starts = f"SELECT {key}, w, unnest(range(0, len(w) - {span - 1})) AS p FROM {table} WHERE len(w) >= {span}"
        seen = lambda seed: ", ".join(f"w[p + {i + 1}]" for i, used in enumerate(seed) if used == "1")
        return " UNION ALL ".join(
            f"SELECT {key}, p, {s} AS seed, [{seen(seed)}] AS seen FROM ({starts})" for s, seed in enumerate(seeds)
        )

    return f"""
    WITH dw AS (SELECT doc_id, {words} AS w FROM documents),
    bw AS (SELECT item_id, {words} AS w FROM benchmark),
    d AS ({windows("dw", "doc_id")}),
    b AS ({windows("bw", "item_id")}),
    diagonal AS (
        SELECT doc_id, item_id, d.p - b.p AS shift, min(b.p) AS first, max(b.p) AS last
        FROM d JOIN b USING (seed, seen) GROUP BY ALL
    ),
    compared AS (
        SELECT doc_id, item_id, shift, len(bw.w) AS size, dw.w AS dw, bw.w AS bw,
            unnest(range(greatest(0, -shift, first - {reach}), least(len(bw.w), len(dw.w) - shift, last + {span + reach}))) AS pos
        FROM diagonal JOIN dw USING (doc_id) JOIN bw USING (item_id)
    ),
    equal AS (SELECT doc_id, item_id, size, shift, pos FROM compared WHERE bw[pos + 1] = dw[pos + shift + 1]),
    near AS (
        SELECT doc_id, item_id, size, shift, pos, count(*) OVER (
            PARTITION BY doc_id, item_id, shift ORDER BY pos RANGE BETWEEN CURRENT ROW AND {reach - 1} FOLLOWING
        ) AS n
        FROM equal
    ),
    overlap AS (
        SELECT doc_id, item_id, shift, count(*) AS matched
        FROM near GROUP BY doc_id, item_id, size, shift
        HAVING max(n) >= ceil(least(size, {reach}) * {share} / 100.0)
    ),
    short AS (
        SELECT doc_id, item_id, p AS shift, len(bw.w) AS matched
        FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM dw WHERE EXISTS (SELECT 1 FROM bw WHERE len(w) < {span}))
            AS dw JOIN bw ON dw.w[p + 1:p + len(bw.w)] = bw.w
        WHERE len(bw.w) BETWEEN {shortest} AND {span - 1}
    )
    SELECT doc_id, item_id, count(*) AS n_overlaps, max(matched)::INTEGER AS matched
    FROM (SELECT * FROM overlap UNION ALL SELECT * FROM short) GROUP BY doc_id, item_id
    """
