"""Context trees over bytes: counts, frozen tables, and scoring of whole texts.

A gram is a context of up to `order` bytes and the byte behind it, packed into
64 bits with the byte itself lowest. Bytes before the start of a text count as
zero. A frozen tree answers, for each of several models at once, the log
probability of every byte of a text: the longest gram the tables hold decides,
and each context that is known but was never followed by the byte adds its
escape.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyfold.llm import texts

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def grams(block: texts.Block, order: int) -> np.ndarray:
    """The packed gram of each byte of a block."""
    n = len(block.data)
    padded = np.zeros(n + 7, np.uint8)
    padded[7:] = block.data
    # the eight bytes that end at each byte, the last one lowest
    out = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64) & np.uint64((1 << 8 * (order + 1)) - 1)
    some = block.nonempty()
    starts, ends = block.offsets[some], block.offsets[some + 1]
    for skip in range(order):
        at = starts + skip
        out[at[at < ends]] &= np.uint64((1 << 8 * (skip + 1)) - 1)
    return out


def suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """The grams of the order: the byte and `order` bytes before it."""
    return keys & np.uint64((1 << 8 * (order + 1)) - 1)


def own(block: texts.Block) -> np.ndarray:
    """Which bytes of a block are not repeated from the piece before."""
    keep = np.ones(len(block.data), bool)
    some = np.flatnonzero(block.lead)
    n = block.lead[some]
    keep[np.repeat(block.offsets[some] - np.cumsum(n) + n, n) + np.arange(n.sum())] = False
    return keep


class Index:
    """Row numbers of distinct 64-bit keys, for many look-ups at once (open addressing)."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.full(1 << bits, EMPTY), np.full(1 << bits, -1, np.int32)
        todo, slot = np.arange(len(keys)), self.slots(keys)
        while len(todo):
            free = self.keys[slot] == EMPTY
            self.rows[slot[free]] = todo[free]
            self.keys[slot[free]] = keys[self.rows[slot[free]]]
            left = self.rows[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 if it has none."""
        slot = self.slots(keys)
        got = self.keys[slot]
        rows = self.rows[slot]
        todo = np.flatnonzero((got != keys) & (got != EMPTY))
        rows[todo] = -1
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            got = self.keys[slot]
            hit = got == keys[todo]
            rows[todo[hit]] = self.rows[slot[hit]]
            on = ~hit & (got != EMPTY)
            todo, slot = todo[on], slot[on]
        return rows


class Tree:
    """Frozen tables: by order, grams with their log probabilities and contexts with their log escapes."""

    def __init__(self, models: int):
        self.models = models
        self.grams: list[tuple[Index, np.ndarray]] = []
        self.contexts: list[tuple[Index, np.ndarray]] = []

    def add(self, keys: np.ndarray, logs: np.ndarray, contexts: np.ndarray, escapes: np.ndarray) -> None:
        """The tables of the next order; logs and escapes have a column for each model."""
        self.grams.append((Index(keys), logs.astype(np.float32)))
        self.contexts.append((Index(contexts), escapes.astype(np.float32)))

    @property
    def order(self) -> int:
        return len(self.grams) - 1

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        """Natural log probabilities, a column for each model."""
        index, logs = self.grams[-1]
        rows = index.find(suffix(keys, self.order))
        out = logs[rows] if len(logs) else np.zeros((len(keys), self.models), np.float32)
        todo = np.flatnonzero(rows < 0)
        out[todo] = 0
        for order in range(self.order, -1, -1):
            if not len(todo):
                return out
            if order < self.order:
                index, logs = self.grams[order]
                rows = index.find(suffix(keys[todo], order))
                out[todo[rows >= 0]] += logs[rows[rows >= 0]]
                todo = todo[rows < 0]
            index, escapes = self.contexts[order]
            rows = index.find(suffix(keys[todo], order) >> np.uint64(8))
            out[todo[rows >= 0]] += escapes[rows[rows >= 0]]
        out[todo] -= np.log(256.0)
        return out


class Recent:
    """Log probabilities of a tree, kept for the grams a task met last (one for each slot)."""

    def __init__(self, tree: Tree, bits: int = 19):
        self.tree, self.shift = tree, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, EMPTY)
        self.values = np.zeros((tree.models, 1 << bits), np.float32)

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        """Natural log probabilities, a row for each model."""
        slot = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = np.take(self.values, slot, axis=1)
        missed = np.flatnonzero(self.keys[slot] != keys)
        if len(missed):
            new, at = np.unique(keys[missed], return_inverse=True)
            logs = self.tree.log_probs(new).T
            out[:, missed] = logs[:, at]
            slot, first = np.unique(slot[missed], return_index=True)
            self.keys[slot] = new[at[first]]
            self.values[:, slot] = logs[:, at[first]]
        return out


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts (a row for each key)."""
    distinct, at = np.unique(keys, return_inverse=True)
    out = np.zeros((len(distinct), *counts.shape[1:]), counts.dtype)
    np.add.at(out, at, counts)
    return distinct, out


def fit(keys: np.ndarray, counts: np.ndarray, order: int, interpolate: bool) -> Tree:
    """A tree with a model for each column of counts.

    A context followed N times by D different bytes escapes with D/(N+D). With
    `interpolate` a known byte also gets the escape's share of the shorter
    context (Witten and Bell); without, only unknown ones do (partial matching).
    """
    tree = Tree(counts.shape[1])
    below = None
    for k in range(order + 1):
        at, n = merged(suffix(keys, k), counts.astype(np.float64))
        contexts, of = np.unique(at >> np.uint64(8), return_inverse=True)
        total, kinds = np.zeros((2, len(contexts), n.shape[1]))
        np.add.at(total, of, n)
        np.add.at(kinds, of, (n > 0).astype(np.float64))
        seen = total > 0
        escape = np.where(seen, kinds / np.where(seen, total + kinds, 1), 1.0)
        short = 1 / 256 if below is None else below[1][np.searchsorted(below[0], suffix(at, k - 1))]
        found = n / np.where(seen, total + kinds, 1)[of]
        p = found + escape[of] * short if interpolate else np.where(n > 0, found, escape[of] * short)
        tree.add(at, np.log(p), contexts, np.log(escape))
        below = (at, p)
    return tree


def counted(
    prepare: Callable[[pa.RecordBatch], tuple[pa.Array, np.ndarray]], order: int, fold: bool = True
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (model int, gram long, n long), counted within each task.

    prepare(batch) gives the texts and the model of each row. Counts are handed
    on whenever a task holds a few million of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for model, parts in sorted(held.items()):
                keys, n = merged(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
                yield pa.record_batch(
                    {
                        "model": pa.array(np.full(len(keys), model, np.int32)),
                        "gram": pa.array(keys.astype(np.int64)),
                        "n": pa.array(n),
                    }
                )
            held.clear()

        for batch in batches:
            column, models = prepare(batch)
            for block in texts.blocks(column, lead=order):
                if fold:
                    block.data = texts.LOWER[block.data]
                keys, keep = grams(block, order), own(block)
                piece = np.repeat(models[block.rows], np.diff(block.offsets))
                for model in np.unique(models[block.rows]):
                    mine = (piece == model) & keep
                    distinct, n = np.unique(keys[mine], return_counts=True)
                    held.setdefault(int(model), []).append((distinct, n.astype(np.int64)))
                    size += len(distinct)
            if size > 1 << 22:
                yield from out()
                size = 0
        yield from out()

    return run


def collected(counts: DataFrame, models: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams and a matrix of their counts, on the driver; for counts of bounded samples only."""
    table = counts.toArrow()
    keys = table.column("gram").to_numpy().astype(np.uint64)
    distinct, at = np.unique(keys, return_inverse=True)
    out = np.zeros((len(distinct), models), np.int64)
    np.add.at(out, (at, table.column("model").to_numpy()), table.column("n").to_numpy())
    return distinct, out
