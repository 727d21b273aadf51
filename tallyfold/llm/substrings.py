"""Removal of word sequences that stand in an earlier document, by De Bruijn compaction.

Every window of k words is an edge of a De Bruijn graph, between its first and
its last k - 1 words. The edges that several documents hold are counted, and
each keeps its source, the coordinates of its first occurrence. An edge whose
occurrences all have the same word before and the same word behind does not
branch; runs of such edges are found by their source coordinates and become one
path, a branching edge is a path of its own. All occurrences of a path begin
with its first edge and run through to its last, so that only first edges have
to be joined with the paths to know all repeated spans. The words of a span are
compared with those at the source by a second hash before they go.

Two things keep the shuffles small. Windows are counted only if their anchor,
the least hash of the shorter runs in them, stands in several documents; equal
windows have equal anchors, so none is missed. And both anchors and first edges
are looked for in bit tables of bounded size: when these fill up, more windows
are counted and dropped, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm import texts
from tallyfold.operators.joins import lookup_stored
from tallyfold.session import discard, materialise

K = 13
#: Words of an anchor.
ANCHOR = 6
#: Bits of the largest table that is sent to the tasks (16 MB).
TABLE_BITS = 1 << 27
#: Spans, of some 30 bytes, that are sent to the texts; more of them are joined with the texts in a shuffle.
SENT_SPANS = 1_000_000
#: Bytes of text that are worked on together; a longer text is alone.
SLICE = 1 << 22
_LAST = np.iinfo(np.int64).max
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose first column has SLICE bytes at most, a row at least."""
    ends = texts.utf8(batch.column(0))[1]
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


class Spelled:
    """The words of some texts: the row and the hash of each, and the first word of each row."""

    def __init__(self, column: pa.Array):
        rows, hashed = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        self.blocks: list[tuple[texts.Block, texts.Words]] = []
        for block in texts.blocks(column):
            found = texts.words(block)
            rows.append(block.rows[found.piece])
            hashed.append(texts.hashes(block.data, found.starts, found.ends))
            self.blocks.append((block, found))
        self.row, self.hashes = np.concatenate(rows), np.concatenate(hashed)
        self.first = np.searchsorted(self.row, np.arange(len(column) + 1))

    def sums(self, seed: np.uint64 = np.uint64(0)) -> Callable[[np.ndarray | slice, np.ndarray | slice], np.ndarray]:
        """Hashes of runs of words, given their starts and ends."""
        up, down = texts._powers(1 << (len(self.hashes) + 1).bit_length())
        words = texts.mix(self.hashes + seed) if seed else self.hashes
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        return lambda start, end: texts.mix((total[end] - total[start]) * down[: len(total)][start])


def windows(words: Spelled, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all windows and their hashes."""
    n = max(0, len(words.hashes) - k + 1)
    starts = np.flatnonzero(words.row[:n] == words.row[k - 1 :]) if n else np.zeros(0, np.int64)
    return starts, words.sums()(starts, starts + k)


def anchors(words: Spelled, k: int, size: int) -> np.ndarray:
    """For each window start, 32 bits of the least hash of `size` words in it."""
    n = max(0, len(words.hashes) - k + 1)
    runs = len(words.hashes) - size + 1
    if not n:
        return np.zeros(0, np.int64)
    low = words.sums(_SECOND)(slice(0, runs), slice(size, size + runs))
    width = 1
    while 2 * width <= k - size + 1:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[k - size + 1 - width :][:n])
    return (texts.mix(low) >> np.uint64(32)).astype(np.int64)


def bit_table(ids: DataFrame, id: str) -> np.ndarray:
    """A bit for each id, of well mixed longs, in a table of bounded size."""
    n = ids.count()
    size = 1 << 15
    while size < min(32 * n, TABLE_BITS):
        size *= 2
    bit = F.col(id).bitwiseAND(F.lit(size - 1)) + 1  # the functions number buckets from 1
    parts = ids.groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
    parts = parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    out = np.zeros((size >> 15, 1 << 12), np.uint8)
    for part in parts:
        out[part["bucket"] - 1] = np.frombuffer(part["bits"], np.uint8)
    return out.ravel()


def has_bit(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids & (8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(text, key, mark): keys as longs, null behind all others; mark tells texts of one key apart, in the upper half of a long."""
    mark = F.shiftleft(F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1)), 32)
    return docs.select(F.col(text).cast("string").alias("text"), _key(key).alias("key"), mark.alias("mark"))


def _key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(int(_LAST)))


def repeated_anchors(rows: DataFrame, k: int, size: int) -> np.ndarray:
    """The bit table of anchors that stand in two rows or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words = Spelled(part.column(0))
                starts, _ = windows(words, k)
                found = anchors(words, k, size)[starts].astype(np.uint64)
                pairs = np.unique((found << np.uint64(32)) + words.row[starts].astype(np.uint64)) >> np.uint64(32)
                anchor, n = np.unique(pairs, return_counts=True)
                yield pa.record_batch({"anchor": anchor.astype(np.int64), "n": n})

    counted = rows.select("text").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    stored = materialise(counted.where("n > 1").select("anchor"), "substring-anchors")
    table = bit_table(stored, "anchor")
    discard(stored)
    return table


def edges(rows: DataFrame, table: np.ndarray, k: int, size: int) -> DataFrame:
    """(edge, key, place, branches): the windows that rows of several keys hold, and their sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words = Spelled(part.column(0))
                starts, edge = windows(words, k)
                some = has_bit(table, anchors(words, k, size)[starts])
                starts, edge = starts[some], edge[some]
                row = words.row[starts]
                around = np.concatenate([[np.uint64(1)], words.hashes, [np.uint64(2)]])
                before = np.where(starts == words.first[row], np.uint64(1), around[starts])
                behind = np.where(starts + k == words.first[row + 1], np.uint64(2), around[starts + k + 1])
                context = texts.mix(texts.mix(before) + behind).astype(np.int64)
                place = part.column(2).to_numpy()[row] + starts - words.first[row]
                key = part.column(1).to_numpy()[row]
                yield pa.record_batch({"edge": edge.astype(np.int64), "key": key, "place": place, "context": context})

    found = rows.mapInArrow(run, "edge long, key long, place long, context long").groupBy("edge")
    found = found.agg(
        F.min("key").alias("key"),
        F.max("key").alias("last"),
        F.min_by("place", "key").alias("place"),
        (F.min("context") != F.max("context")).alias("branches"),
    )
    return found.where("last > key").drop("last")


def paths(edges: DataFrame) -> DataFrame:
    """(edge, key, place, length): paths by their first edge, with their source and number of edges, stored.

    Edges that do not branch share their occurrences with the edges beside them,
    so their sources stand side by side as well.
    """
    along = Window.partitionBy("key").orderBy("place")
    before = F.lag(F.struct("place", "branches")).over(along)
    goes_on = ~F.col("branches") & ~before["branches"] & (before["place"] == F.col("place") - 1)
    out = edges.withColumn("start", F.when(~F.coalesce(goes_on, F.lit(False)), F.col("place")))
    out = out.withColumn("start", F.max("start").over(along))
    out = out.groupBy("key", "start").agg(F.min_by("edge", "place").alias("edge"), F.count("*").alias("length"))
    return materialise(out.select("edge", "key", F.col("start").alias("place"), "length"), "substring-paths")


def _with_spans(docs: DataFrame, spans: DataFrame, n_spans: int) -> DataFrame:
    """The rows with the spans of their key, in an array that is null if there are none."""
    columns = [c for c in spans.columns if c != "key"]
    grouped = spans.groupBy("key").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    if n_spans <= SENT_SPANS:
        return docs.join(F.broadcast(grouped), "key", "left")
    return lookup_stored(docs, materialise(grouped, "substring-spans"), ["key"], small=False)


def _placed(part: pa.RecordBatch, words: Spelled, column: int, k: int) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]:
    """The spans of a batch that lie in their row's text, their first words, the words behind their last, and their second hashes."""
    lists = part.column(column)
    spans = lists.flatten()
    row = pc.list_parent_indices(lists).to_numpy()
    place, length = (spans.field(name).to_numpy(zero_copy_only=False) for name in ("place", "length"))
    mine = place & ~np.int64(0xFFFFFFFF) == part.column(2).to_numpy()[row]
    start = words.first[row] + (place & 0xFFFFFFFF)
    end = start + length + k - 1
    mine &= end <= words.first[row + 1]
    start, end = start[mine], end[mine]
    return spans.filter(pa.array(mine)), start, end, words.sums(_SECOND)(start, end).astype(np.int64)


def proven(rows: DataFrame, paths: DataFrame, n_paths: int, k: int) -> DataFrame:
    """(edge, key, length, proof): the paths with the second hash of the words at their source, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words = Spelled(part.column(0))
                spans, start, end, proof = _placed(part, words, 3, k)
                row = words.row[start] if len(start) else start
                key = part.column(1).to_numpy()[row]
                yield pa.record_batch({"edge": spans.field("edge"), "key": key, "length": spans.field("length"), "proof": proof})

    found = _with_spans(rows, paths, n_paths).where("spans IS NOT NULL").select("text", "key", "mark", "spans")
    found = found.mapInArrow(run, "edge long, key long, length long, proof long")
    # rows that are repeated prove their paths again
    return materialise(found.groupBy("edge").agg(*[F.min(c).alias(c) for c in ("key", "length", "proof")]), "substring-proofs")


def occurrences(rows: DataFrame, firsts: np.ndarray, k: int) -> DataFrame:
    """(edge, key, place) of the windows that may be first edges of paths, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words = Spelled(part.column(0))
                starts, edge = windows(words, k)
                some = has_bit(firsts, edge.astype(np.int64))
                starts, edge = starts[some], edge[some].astype(np.int64)
                row = words.row[starts]
                place = part.column(2).to_numpy()[row] + starts - words.first[row]
                yield pa.record_batch({"edge": edge, "key": part.column(1).to_numpy()[row], "place": place})

    # rows that are repeated have the same occurrences
    return materialise(rows.mapInArrow(run, "edge long, key long, place long"), "substring-occurrences")


def _kept(words: Spelled, gone: np.ndarray, n: int) -> list[bytes]:
    """The words of each row that are not gone, joined by one space."""
    out: list[list[bytes]] = [[] for _ in range(n)]
    at = 0
    for block, found in words.blocks:
        left = ~gone[at : at + len(found.starts)]
        at += len(left)
        starts, ends, piece = found.starts[left], found.ends[left], found.piece[left]
        if not len(starts):
            continue
        # the white space behind a word is its space, but not behind the last one of a piece
        final = np.append(np.diff(piece) > 0, True)
        step = np.zeros(len(block.data) + 2, np.int8)
        np.add.at(step, starts, 1)
        np.add.at(step, ends + ~final, -1)
        inside = np.cumsum(step[: len(block.data)], dtype=np.int8) > 0
        data = np.where(texts.SPACE[block.data], np.uint8(0x20), block.data)[inside].tobytes()
        size = np.bincount(piece, ends - starts + ~final, len(block.rows)).astype(np.int64)
        stops = np.cumsum(size)
        for i in np.flatnonzero(size):
            out[block.rows[i]].append(data[stops[i] - size[i] : stops[i]])
    return [b" ".join(parts) for parts in out]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, anchor: int = ANCHOR) -> DataFrame:
    """The rows of docs with n_words, n_removed and kept, which replace columns of those names.

    Words are runs of other than ASCII white space. A word goes if a window of k
    words around it also stands in a row of a smaller key; `kept` is the rest,
    joined by one space. Windows are judged on the input. Keys are whole numbers;
    a null key is larger than all others, rows of one key remove nothing from each
    other. A null text has no words. A task holds the words of one text at least,
    so its memory follows the longest text; a span whose words differ from its
    source, which takes two texts of equal hashes, is kept.
    """
    made = ("n_words", "n_removed", "kept")
    rows = _text_rows(docs, key, text)
    table = repeated_anchors(rows, k, min(anchor, k))
    found = paths(edges(rows, table, k, min(anchor, k)))
    n_paths = found.count()
    checked = proven(rows, found, n_paths, k)
    heads = occurrences(rows, bit_table(checked, "edge"), k)
    spans = lookup_stored(heads, checked.withColumnRenamed("key", "source"), ["edge"])
    spans = spans.where(F.col("key") > F.col("source")).select("key", "place", "length", "proof").distinct()
    spans = materialise(spans, "substring-removals")
    discard(found, checked, heads)

    kept = [c for c in docs.columns if c not in made]
    wide = docs.select(*[F.col(c) for c in kept], _key(key).alias("_key")).select(
        F.struct(*kept).alias("row"), F.col("_key").alias("key")
    )
    mark = F.shiftleft(F.xxhash64(F.coalesce(F.col(f"row.{text}"), F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1)), 32)
    wide = _with_spans(wide, spans, spans.count())
    wide = wide.select(F.col(f"row.{text}").cast("string").alias("text"), "key", mark.alias("mark"), "spans", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words = Spelled(part.column(0))
                n = len(words.hashes)
                wanted, start, end, proof = _placed(part, words, 3, k)
                same = proof == wanted.field("proof").to_numpy(zero_copy_only=False)
                cover = np.bincount(start[same], minlength=n + 1) - np.bincount(end[same], minlength=n + 1)
                gone = np.cumsum(cover[:n]) > 0
                size = np.diff(words.first)
                removed = np.bincount(words.row[gone], minlength=part.num_rows)
                left = pa.array(_kept(words, gone, part.num_rows), pa.binary()).cast(pa.string())
                columns = [*part.column(4).flatten(), pa.array(size), pa.array(removed), left]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *made])

    schema = texts.extended(docs.select(*kept).schema, n_words="long", n_removed="long", kept="string")
    return wide.mapInArrow(run, schema)


def sql(k: int = K) -> str:
    """For DuckDB, the documents' numbers of words and removed words, and the digest of what is kept."""
    return rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (
        SELECT doc_id, p, w[p:p + {k - 1}] AS seen FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS p FROM w)
    ),
    first AS (SELECT seen, min(doc_id) AS source FROM win GROUP BY seen HAVING min(doc_id) < max(doc_id)),
    gone AS (
        SELECT doc_id, list(DISTINCT p + i) AS gone
        FROM (SELECT doc_id, p FROM win JOIN first USING (seen) WHERE doc_id > source), range({k}) AS r(i)
        GROUP BY doc_id
    ),
    word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w),
    lost AS (SELECT doc_id, unnest(gone) AS p FROM gone),
    rest AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
        FROM word ANTI JOIN lost USING (doc_id, p) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN rest USING (doc_id)
    """
