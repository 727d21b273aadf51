"""Jaccard join on word n-grams by MinHash banding.

Texts are sets of n-grams of lower-cased words (runs of other than ASCII white
space); a text with fewer words is one n-gram of all of them, and one without
words has none and joins with nothing. Texts with equal sets form one class and
are compared once. Band hashes are shuffled, each class is linked to the
smallest class of its buckets, and the components of these links are verified:
all pairs of classes in a component are compared on their full sets, in tiles
of two blocks, so that no pair is ever a row and a task holds two blocks.

Words are hashed to 64 bits, sets are told apart by a 128-bit digest. Bands and
rows are chosen for the recall asked for at the threshold itself; pairs above
it, and pairs in components that other links hold together, are found with more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts
from tallyfold.llm.components import connected
from tallyfold.llm.inputs import sent
from tallyfold.session import discard, materialise

#: Classes in a block of a tile.
BLOCK = 128
#: Bits of the largest filter of wanted ids that is sent to the tasks (16 MB).
FILTER_BITS = 1 << 27


def bands_for(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: most rows, and so fewest chance hits, that reach the recall with so many hashes at most."""
    best = None
    for rows in range(1, hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit > 1e-12 else hashes + 1
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hashes cannot reach a recall of {recall}")
    return best


def gram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row; empty for texts without words."""
    rows = len(column)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for block in texts.blocks(column):
        found = texts.words(block)
        data = texts.LOWER[block.data]
        parts.append((block.rows[found.piece], texts.hashes(data, found.starts, found.ends)))
    of = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    words = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint64)
    length = np.bincount(of, minlength=rows)
    ends = np.cumsum(length)
    grams = words.copy()
    for j in range(1, n):
        grams[:-j] = texts.mix(grams[:-j] + np.uint64(j)) + words[j:] if len(words) > j else grams[:-j]
    out = []
    for end, size in zip(ends, length, strict=True):
        if size == 0:
            out.append(grams[:0])
        elif size < n:
            whole = int(words[end - size])
            for x in words[end - size + 1 : end]:
                whole = (whole * 0x9E3779B97F4A7C15 + int(x)) % (1 << 64)
            out.append(texts.mix(np.array([whole], np.uint64) + np.uint64(size)))
        else:
            out.append(np.unique(grams[end - size : end - n + 1]))
    return out


def signatures(sets: list[np.ndarray], bands: int, rows: int, seed: int = 5) -> np.ndarray:
    """Band hashes, a row for each set; sets must not be empty."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32) if sets else np.zeros(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    shifts = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    out = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            low = np.minimum.reduceat(flat * factors[i] + shifts[i], starts) if len(sets) else flat
            key = texts.mix(key + low)
        out[:, band] = key
    return out


def digest(grams: np.ndarray) -> bytes | None:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def described(df: DataFrame, text: str, key: str, n: int, bands: int, rows: int) -> DataFrame:
    """(row, id, class, bands) of each row, stored; class and bands are null without words."""
    kind = df.schema[key].dataType.simpleString()
    slim = df.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = gram_sets(part.column(1), n)
                some = [s for s in sets if len(s)]
                filled = np.array([bool(len(s)) for s in sets], bool)
                hashed = signatures(some, bands, rows).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(filled * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashed.ravel()))
                yield pa.record_batch(
                    {
                        "row": pa.array(first + np.arange(len(sets))),
                        "id": part.column(0),
                        "class": pa.array([digest(s) for s in sets], pa.binary()),
                        "bands": lists,
                    }
                )
                first += len(sets)

    schema = f"row long, id {kind}, class binary, bands array<long>"
    return materialise(slim.mapInArrow(run, schema), "ngram-classes")


def candidates(classes: DataFrame) -> DataFrame:
    """(class, root): the component of every class that shares a bucket with another one.

    A class is linked with the least head of its buckets, and so are their other
    heads: as most classes of a group have heads in common, few links remain.
    """
    keys = classes.select("class", F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("class").alias("head"), F.count("*").alias("n")).where("n > 1")
    found = keys.join(heads.select("key", "head"), "key").groupBy("class")
    found = found.agg(F.min("head").alias("least"), F.collect_set("head").alias("heads"))
    found = materialise(found, "ngram-heads")
    others = found.select(F.explode("heads").alias("a"), F.col("least").alias("b")).distinct()
    roots = connected(found.select(F.col("class").alias("a"), F.col("least").alias("b")).union(others))
    discard(found)
    return roots.select(F.col("node").alias("class"), "root")


def _filter(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each id, in a table of bounded size; other ids meet few set bits while ids are few."""
    n = ids.count()
    size = 1 << 15
    while size < min(32 * n, FILTER_BITS):
        size *= 2
    bit = F.pmod(F.xxhash64("id"), F.lit(size))
    # the functions number buckets from 1
    at = F.bitmap_bucket_number(bit + 1).alias("bucket")
    parts = ids.groupBy(at).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias("bits")).collect()
    out = np.zeros((size >> 15, 1 << 15), bool)
    for part in parts:
        out[part["bucket"] - 1] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), bitorder="little")
    return np.packbits(out.ravel(), bitorder="little")


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of a with all of b."""
    grams = np.concatenate([*a, *b])
    of = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in [*a, *b]])
    _, at, n = np.unique(grams, return_inverse=True, return_counts=True)
    shared = n[at] > 1
    _, at = np.unique(at[shared], return_inverse=True)
    of = of[shared]
    out = np.zeros((len(a), len(b)), np.float64)
    step = 1 << 15
    order = np.argsort(at, kind="stable")
    at, of = at[order], of[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, step):
        part = slice(*np.searchsorted(at, [low, low + step]))
        has = np.zeros((len(a) + len(b), step), np.float32)
        has[of[part], at[part] - low] = 1
        out += has[: len(a)] @ has[len(a) :].T
    return out


def tile(
    classes: list[bytes], first: np.ndarray, own: bool, sets: list[np.ndarray], threshold: Fraction
) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """The classes of a tile, the smallest one each is linked with, however indirectly, and its links.

    first marks the first of the two blocks; with `own` there is only one, compared with itself.
    """
    order = sorted(range(len(classes)), key=lambda i: classes[i])
    classes, first, sets = [classes[i] for i in order], first[order], [sets[i] for i in order]
    size = np.array([len(s) for s in sets], np.float64)
    these, those = np.flatnonzero(first), np.flatnonzero(first if own else ~first)
    common = _overlaps([sets[i] for i in these], [sets[i] for i in those])
    union = size[these][:, None] + size[those][None, :] - common
    linked = np.zeros((len(sets), len(sets)), bool)
    linked[np.ix_(these, those)] = common * threshold.denominator >= union * threshold.numerator
    linked |= linked.T
    np.fill_diagonal(linked, False)
    label = np.arange(len(sets))
    while True:
        near = np.where(linked, label[None, :], len(sets)).min(axis=1, initial=len(sets))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return classes, [classes[i] for i in label], linked.sum(axis=1)
        label = new


def verified(df: DataFrame, text: str, key: str, found: DataFrame, reps: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """(class, other, links): spanning links of verified pairs, and how many links of each class a tile holds."""
    sizes = found.groupBy("root").agg(F.count("*").alias("members"))
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    members = found.join(sizes, "root").select("class", "root", parts.alias("parts"))
    members = members.withColumn("block", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    wanted = materialise(members.join(reps.select("class", "id"), "class"), "ngram-members")
    wanted_bits = df.sparkSession.sparkContext.broadcast(_filter(wanted.select("id")))
    slim = df.select(F.col(text).alias("text"), F.xxhash64(F.col(key).alias("id")).alias("hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted_bits.value
        size = len(bits) * 8
        for batch in batches:
            at = batch.column(1).to_numpy() % size
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for first in range(0, batch.num_rows, 1000):
                sets = [s for s in gram_sets(batch.column(0).slice(first, 1000), n) if len(s)]
                yield pa.record_batch(
                    {
                        "class": pa.array([digest(s) for s in sets], pa.binary()),
                        "grams": pa.array([s.tobytes() for s in sets], pa.binary()),
                    }
                )

    sets = slim.mapInArrow(run, "class binary, grams binary")
    # other rows may have the wanted class too: one is enough
    sets = sets.join(wanted.drop("id"), "class").groupBy("class").agg(
        *[F.first(c).alias(c) for c in ("root", "parts", "block", "grams")]
    )
    block = F.col("block")
    pairs = sets.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.withColumns({"low": F.least(block, F.col("with")), "high": F.greatest(block, F.col("with"))})

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        grams = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
        first = pdf["block"].to_numpy() == key[1]
        classes, others, links = tile(list(pdf["class"]), first, key[1] == key[2], grams, threshold)
        out = pd.DataFrame({"class": classes, "other": others, "links": links})
        return out[out["links"] > 0]

    schema = "class binary, other binary, links long"
    links = materialise(pairs.groupBy("root", "low", "high").applyInPandas(compare, schema), "ngram-links")
    discard(wanted)
    return links


def groups(
    df: DataFrame, text: str, key: str, n: int, threshold: str, recall: float, hashes: int
) -> tuple[DataFrame, DataFrame]:
    """The stored rows (row, id, class) and the stored (class, root, links) of every linked class."""
    limit = Fraction(threshold)
    bands, rows = bands_for(float(limit), recall, hashes)
    stored = described(df, text, key, n, bands, rows)
    some = stored.where(F.col("class").isNotNull())
    reps = some.groupBy("class").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands"))
    reps = materialise(reps, "ngram-reps")
    found = candidates(reps)
    links = verified(df, text, key, found, reps, n, limit)
    roots = connected(links.select(F.col("class").alias("a"), F.col("other").alias("b")))
    counts = links.groupBy("class").agg(F.sum("links").alias("links"))
    linked = materialise(counts.join(roots.select(F.col("node").alias("class"), "root"), "class", "left"), "ngram-roots")
    slim = materialise(stored.drop("bands"), "ngram-rows")
    discard(stored, reps, links)
    return slim, linked


def join(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    n: int = 5,
    threshold: str = "0.8",
    recall: float = 0.999,
    hashes: int = 144,
) -> DataFrame:
    """(key, class_id, n_links, n_copies) of each row.

    class_id is the smallest key among the rows that links of at least the
    threshold connect with the row, equal sets included. n_links is the number
    of different sets that the row's set is linked with, n_copies the number of
    other rows with an equal set. Rows without words, null texts among them, are
    classes of their own. Null keys come out as they are and count as no id.
    """
    stored, linked = groups(df, text, key, n, threshold, recall, hashes)
    some = stored.where(F.col("class").isNotNull())
    each = some.groupBy("class").agg(F.min("id").alias("first"), F.count("*").alias("rows"))
    each = each.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = each.groupBy("root").agg(F.min("first").alias("class_id"))
    info = each.join(smallest, "root").select("class", "class_id", "links", "rows")
    out = stored.select("id", "class").join(info, "class", "left")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("rows") - 1, F.lit(0)).alias("n_copies"),
    )


def keep_one(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    n: int = 5,
    threshold: str = "0.8",
    recall: float = 0.999,
    hashes: int = 144,
) -> DataFrame:
    """The frame with one row of each class, the one with the smallest key; equal rows are told apart by position."""
    place = "_place"
    while place in df.columns:
        place = "_" + place
    placed = materialise(df.withColumn(place, F.monotonically_increasing_id()), "ngram-input")
    by_key = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), place)
    ids = placed.select(by_key.alias("id"), F.col(text).alias("text"))
    stored, linked = groups(ids, "text", "id", n, threshold, recall, hashes)
    some = stored.where(F.col("class").isNotNull()).select("class", "id")
    rooted = some.join(linked.select("class", "root"), "class", "left")
    rooted = materialise(rooted.select("id", F.coalesce("root", "class").alias("root")), "ngram-groups")
    first = rooted.groupBy("root").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    dropped = rooted.join(first, "root").where("id != first").select(F.col(f"id.{place}").alias(place))
    dropped = materialise(dropped, "ngram-dropped")
    discard(stored, linked, rooted)
    return placed.join(sent(dropped), place, "left_anti").drop(place)
