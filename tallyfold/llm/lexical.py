"""Exact ranked search by terms, with posting lists in geometric blocks.

Terms are maximal runs of ASCII letters and digits and of all other than ASCII
characters; A to Z are lower-cased. A document's coordinate for a term is
(10^9 tf) div (1000 tf + 8 m), m its length in mean lengths, and its score for an
item the sum of the weighted coordinates of the item's terms.

The documents are stored once as vectors over the items' terms. A task takes
them in shards. In a shard, a tree of random projections puts similar documents
next to one another, and each term's posting list is cut along it into blocks:
the largest branches that hold no more than BLOCK of its documents. A block
stores the coordinatewise maximum of its documents. Terms are numbered by falling
weight, and a block's summary covers its own term and lighter ones: a document
with a heavier term of the item also stands in that term's list. The weighted
sum of a summary thus bounds every score that only this block could find. Lists
and blocks whose bound is below the k-th best score so far are skipped, the
others are scored in the order of their bounds, until none is left.

A shard holds some documents of all lists, so that no list is in one place and
a term of all documents is as good as any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm import texts
from tallyfold.session import discard, materialise

#: Documents in a block, and in a shard; a shard is also closed at so many coordinates.
BLOCK = 32
SHARD = 4096
SHARD_ENTRIES = 1 << 20
#: Terms of items, counted for each item, that one pass over the documents looks for.
PASS = 200_000
#: Pairs of coordinates that are worked on together when summaries are made.
PAIRS = 1 << 21
#: Bits of the table of term pairs that items hold; chance hits only store a coordinate more.
PAIR_BITS = 1 << 26
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NULL = np.iinfo(np.int64).max

GAP = np.ones(256, bool)
GAP[0x30:0x3A] = GAP[0x41:0x5B] = GAP[0x61:0x7B] = GAP[0x80:] = False
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """The distinct terms of a text, none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.array_remove(F.split(lower, SPLIT), ""))


@dataclass
class Vocabulary:
    """Terms by the order of their hashes. A word is a term if hash and length agree."""

    hashes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> tuple[Vocabulary, dict[str, int]]:
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        ends = np.cumsum(lengths)
        hashed = texts.hashes(np.frombuffer(b"".join(raw), np.uint8), ends - lengths, ends) if raw else np.zeros(0, np.uint64)
        order = np.argsort(hashed, kind="stable")
        if (np.diff(hashed[order]) == 0).any():
            raise ValueError("two terms with equal hashes")
        return cls(hashed[order], lengths[order]), {words[i]: n for n, i in enumerate(order)}

    def find(self, block: texts.Block) -> tuple[np.ndarray, np.ndarray]:
        """The piece of each word of a block, and the number of its term, -1 for other words."""
        found = texts.words(block, GAP)
        hashed = texts.hashes(texts.LOWER[block.data], found.starts, found.ends)
        at = np.minimum(np.searchsorted(self.hashes, hashed), max(0, len(self.hashes) - 1))
        if not len(self.hashes):
            return found.piece, np.full(len(hashed), -1)
        same = (self.hashes[at] == hashed) & (self.lengths[at] == found.ends - found.starts)
        return found.piece, np.where(same, at, -1)


def forward(docs: DataFrame, key: str, text: str, vocabulary: Vocabulary) -> DataFrame:
    """(id, n, terms, tf) of every row with a term, stored; terms are those of the vocabulary, in order."""
    v = max(1, len(vocabulary.hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in texts.blocks(batch.column(1)):
                piece, at = vocabulary.find(block)
                row = block.rows[piece]
                n += np.bincount(row, minlength=len(n))
                some, count = np.unique((row * v + at)[at >= 0], return_counts=True)
                keys.append(some)
                counts.append(count)
            # a long text has several blocks
            some, at = np.unique(np.concatenate(keys), return_inverse=True)
            tf = np.bincount(at, np.concatenate(counts), len(some)).astype(np.int64)
            ends = pa.array(np.searchsorted(some, np.arange(len(n) + 1) * v).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((some % v).astype(np.int32), tf)]
            out = pa.record_batch({"id": batch.column(0), "n": pa.array(n), "terms": lists[0], "tf": lists[1]})
            yield out.filter(pa.array(n > 0))

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return materialise(rows.mapInArrow(run, "id long, n long, terms array<int>, tf array<long>"), "lexical-vectors")


@dataclass
class Queries:
    """Items as sorted term numbers; terms are numbered anew by falling weight."""

    slots: np.ndarray
    terms: list[np.ndarray]
    weights: np.ndarray
    rank: np.ndarray
    n_docs: int
    n_terms: int
    pairs: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.pairs = np.zeros(PAIR_BITS // 8, np.uint8)
        for t in self.terms:
            a, b = np.triu_indices(len(t)) if len(t) < 2000 else (None, None)
            if a is None:  # a very long item: row by row
                for i in range(len(t)):
                    self._note(np.full(len(t) - i, t[i]), t[i:])
            else:
                self._note(t[a], t[b])

    def _bit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.uint64) * np.uint64(max(1, len(self.weights))) + b.astype(np.uint64)
        return (key * _FACTOR) >> np.uint64(64 - (PAIR_BITS.bit_length() - 1))

    def _note(self, a: np.ndarray, b: np.ndarray) -> None:
        at = self._bit(a, b)
        np.bitwise_or.at(self.pairs, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether an item holds both terms; now and then true though none does."""
        at = self._bit(a, b)
        return (self.pairs[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0

    def impacts(self, n: np.ndarray, tf: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Coordinates for term counts `tf` in documents `of` with n terms."""
        if len(n) and int(n.max()) > _NULL // (90 * max(1, self.n_docs)):
            share = np.array([90 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        else:
            share = 90 * n * self.n_docs // max(1, self.n_terms)
        return 1_000_000_000 * tf // (1000 * tf + 8 * (100 - 90 + share)[of])


def projected(of: np.ndarray, ids: np.ndarray, values: np.ndarray, n: int, levels: int) -> np.ndarray:
    """The leaf of each document in a tree whose levels halve branches at the median of a random projection."""
    norm = np.sqrt(np.bincount(of, values * values, n)) + 1e-9
    signs = texts.mix(ids.astype(np.uint64) + np.uint64(1))
    leaf = np.zeros(n, np.int64)
    for level in range(levels):
        sign = np.where((signs >> np.uint64(level)) & np.uint64(1), values, -values)
        order = np.lexsort((np.bincount(of, sign, n) / norm, leaf))
        branch = leaf[order]
        first = np.searchsorted(branch, branch)
        size = np.searchsorted(branch, branch, "right") - first
        leaf[order] = 2 * branch + (2 * (np.arange(n) - first) >= size)
    return leaf


class Shard:
    """Some documents, their posting lists in blocks, and the blocks' summaries."""

    def __init__(self, queries: Queries, ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.queries, self.ids, self.ptr = queries, ids, ptr
        n = len(ids)
        of = np.repeat(np.arange(n), np.diff(ptr))
        order = np.lexsort((terms, of))
        self.terms, self.values = terms[order], values[order]
        weighed = queries.weights[self.terms] * self.values.astype(np.float64)
        levels = max(1, (n - 1).bit_length())
        leaf = projected(of, self.terms, weighed, n, levels)
        posting = np.lexsort((leaf[of], self.terms))
        self.docs, term = of[posting], self.terms[posting]
        block = self._blocks(term, leaf[self.docs], levels)
        first = np.flatnonzero(np.diff(block, prepend=-1))
        self.block_ptr = np.append(first, len(posting))
        self.list_of = np.searchsorted(term[first], np.arange(len(queries.weights) + 1))
        self.highest = np.zeros(len(queries.weights), np.int64)
        np.maximum.at(self.highest, self.terms, self.values)
        self._summaries(posting, of, term)

    @staticmethod
    def _blocks(term: np.ndarray, leaf: np.ndarray, levels: int) -> np.ndarray:
        """The block of each posting: its largest branch with no more than BLOCK documents of its list."""
        out = np.full(len(term), -1, np.int64)
        todo = np.arange(len(term))
        for level in range(levels + 1):
            branch = (term[todo] << levels) + (leaf[todo] >> (levels - level))
            first = np.flatnonzero(np.diff(branch, prepend=-1))
            size = np.diff(np.append(first, len(todo)))
            small = np.repeat((size <= BLOCK) | (level == levels), size)
            out[todo[small]] = todo[np.repeat(first, size)][small]
            todo = todo[~small]
            if not len(todo):
                break
        return out

    def _summaries(self, posting: np.ndarray, of: np.ndarray, term: np.ndarray) -> None:
        """The largest value of each term, not heavier than its own, that a block's documents have."""
        behind = self.ptr[of[posting] + 1] - posting
        done = np.concatenate([[0], np.cumsum(behind)])[self.block_ptr]
        v = len(self.queries.weights)
        sizes, terms, values = [], [], []
        at, n_blocks = 0, len(self.block_ptr) - 1
        while at < n_blocks:
            stop = min(n_blocks, max(at + 1, int(np.searchsorted(done, done[at] + PAIRS, "right")) - 1))
            low, high = self.block_ptr[at], self.block_ptr[stop]
            length = behind[low:high]
            total = int(length.sum())
            entry = np.repeat(posting[low:high] - (np.cumsum(length) - length), length) + np.arange(total)
            own, other = np.repeat(term[low:high], length), self.terms[entry]
            block = np.repeat(np.repeat(np.arange(stop - at), np.diff(self.block_ptr[at : stop + 1])), length)
            kept = self.queries.together(own, other)
            key = block[kept] * v + other[kept]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            sizes.append(np.bincount(key[first] // v, minlength=stop - at))
            terms.append(key[first] % v)
            values.append(np.maximum.reduceat(self.values[entry[kept][order]], first) if len(first) else key)
            at = stop
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.sum_ptr = np.concatenate([[0], np.cumsum(joined(sizes))]).astype(np.int64)
        self.sum_terms, self.sum_values = joined(terms), joined(values)

    def bounds(self, weights: np.ndarray, term: int) -> np.ndarray:
        """For each block of a list, more than no score that only this list can find."""
        low, high = self.sum_ptr[self.list_of[term]], self.sum_ptr[self.list_of[term + 1]]
        part = weights[self.sum_terms[low:high]] * self.sum_values[low:high]
        return np.add.reduceat(part, self.sum_ptr[self.list_of[term] : self.list_of[term + 1]] - low)

    def scores(self, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        length = self.ptr[docs + 1] - self.ptr[docs]
        ends = np.cumsum(length)
        entry = np.repeat(self.ptr[docs] - (ends - length), length) + np.arange(int(length.sum()))
        return np.add.reduceat(weights[self.terms[entry]] * self.values[entry], ends - length)

    def search(self, wanted: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Bring the documents that may be among the best to `best`; returns how many were scored.

        weights: those of the item's terms, zero for all others.
        """
        wanted = wanted[self.highest[wanted] > 0]
        if not len(wanted):
            return 0
        reach = np.cumsum((weights[wanted] * self.highest[wanted])[::-1])[::-1]
        wanted = wanted[reach >= max(1, best.floor)]
        if not len(wanted):
            return 0
        blocks = np.concatenate([np.arange(self.list_of[t], self.list_of[t + 1]) for t in wanted])
        bounds = np.concatenate([self.bounds(weights, t) for t in wanted])
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        seen = np.zeros(len(self.ids), bool)
        at, step, n_scored = 0, 4, 0
        while at < len(blocks) and bounds[at] >= max(1, best.floor):
            mine = blocks[at : at + step][bounds[at : at + step] >= max(1, best.floor)]
            at, step = at + step, 2 * step
            length = self.block_ptr[mine + 1] - self.block_ptr[mine]
            ends = np.cumsum(length)
            docs = self.docs[np.repeat(self.block_ptr[mine] - (ends - length), length) + np.arange(int(length.sum()))]
            docs = np.unique(docs[~seen[docs]])
            if len(docs):
                seen[docs] = True
                n_scored += len(docs)
                best.add(self.scores(weights, docs), self.ids[docs])
        return n_scored


class Best:
    """The k best scores above 0 and their ids; ties go to smaller ids. `floor` is what a further one must reach."""

    def __init__(self, k: int):
        self.k, self.floor = k, 0
        self.scores = self.ids = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores > 0) & (scores >= self.floor)
        scores, ids = np.concatenate([self.scores, scores[some]]), np.concatenate([self.ids, ids[some]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.floor = int(self.scores[-1])


def _shards(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[Shard]:
    """The documents of a task in shards of bounded size; those without a wanted term are left out."""

    def made(parts: list[tuple[np.ndarray, ...]]) -> Shard:
        ids, n, length, terms, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
        of = np.repeat(np.arange(len(ids)), length)
        ptr = np.concatenate([[0], np.cumsum(length)])
        return Shard(queries, ids, ptr, queries.rank[terms], queries.impacts(n, tf, of))

    parts: list[tuple[np.ndarray, ...]] = []
    rows = entries = 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
        length = pc.list_value_length(batch.column(2)).to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(length)])
        at = 0
        while at < batch.num_rows:
            room = int(np.searchsorted(ends, ends[at] + SHARD_ENTRIES - entries, "right")) - 1
            stop = min(batch.num_rows, at + SHARD - rows, max(room, at + (not parts)))
            if stop > at:
                part = batch.slice(at, stop - at)
                ids = pc.fill_null(part.column(0), _NULL).to_numpy()
                lists = [part.column(i).flatten().to_numpy() for i in (2, 3)]
                parts.append((ids, part.column(1).to_numpy(), length[at:stop], *lists))
                rows, entries = rows + stop - at, entries + int(ends[stop] - ends[at])
            if parts and (stop == at or rows >= SHARD or entries >= SHARD_ENTRIES):
                yield made(parts)
                parts, rows, entries = [], 0, 0
            at = stop
    if parts:
        yield made(parts)


def found(vectors: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(_slot, id, score): for every item the k best documents of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.terms]
        for shard in _shards(batches, queries):
            for b, t in zip(best, queries.terms, strict=True):
                weights = np.zeros(len(queries.weights), np.int64)
                weights[t] = queries.weights[t]
                shard.search(t, weights, b)
        for slot, b in zip(queries.slots, best, strict=True):
            if len(b.ids):
                ids = pa.array(b.ids, mask=b.ids == _NULL)
                yield pa.record_batch({"_slot": np.full(len(b.ids), slot), "id": ids, "score": b.scores})

    return vectors.mapInArrow(run, "_slot long, id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item, rank, key, score): the k best documents of every item, ranks from 1, ties to the smaller key.

    Every row of docs is a document and every row of items an item, repeated ones
    too. Keys are whole numbers; a null key comes behind all others (and so would
    2^63 - 1, which is shown as null). Null texts have no terms, items without
    terms no rows. The items are worked on in passes over the documents, each of
    about PASS terms at most, an item at least.
    """
    spark = docs.sparkSession
    slots = items.select(F.col(item).alias("_item"), terms(F.col(item_text)).alias("_terms"))
    slots = materialise(slots.withColumn("_slot", F.monotonically_increasing_id()), "lexical-items")
    total = slots.agg(F.sum(F.size("_terms"))).first()[0] or 0
    parts = max(1, -(-total // PASS))
    out = None
    for part in range(parts):
        mine = slots.where((F.pmod(F.xxhash64("_slot"), F.lit(parts)) == part) & (F.size("_terms") > 0))
        mine = mine.select("_slot", "_terms").collect()
        if not mine:
            continue
        vocabulary, number = Vocabulary.of(sorted({t for r in mine for t in r["_terms"]}))
        vectors = forward(docs, key, text, vocabulary)
        n_docs, n_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(number), np.int64)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        order = np.lexsort((np.arange(len(df)), -weights))
        rank = np.empty(len(df), np.int64)
        rank[order] = np.arange(len(df))
        ranked = [np.sort(rank[[number[t] for t in r["_terms"]]]) for r in mine]
        queries = Queries(np.array([r["_slot"] for r in mine]), ranked, weights[order], rank, n_docs, n_terms)
        hits = materialise(found(vectors, queries, k), "lexical-hits")
        discard(vectors)
        out = hits if out is None else out.unionAll(hits)
    if out is None:
        out = spark.createDataFrame([], "_slot long, id long, score long")
    best = Window.partitionBy("_slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    out = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.join(slots.drop("_terms"), "_slot").select(F.col("_item").alias(item), "rank", F.col("id").alias(key), "score")


def sql(k: int = 10) -> str:
    """For DuckDB, the k best documents of every benchmark item."""
    listed = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH d AS (SELECT doc_id, {listed} AS t FROM documents WHERE text IS NOT NULL),
    counted AS (SELECT doc_id, t, len(t) AS n FROM d WHERE len(t) > 0),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM counted),
    wanted AS (SELECT DISTINCT item_id, unnest({listed}) AS term FROM benchmark),
    posting AS (
        SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM counted)
        WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
    ),
    weight AS (
        SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
        FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), whole
    ),
    scored AS (
        SELECT item_id, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
        FROM posting JOIN weight USING (term) JOIN wanted USING (term), whole
        GROUP BY item_id, doc_id
    ),
    ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}
    """
