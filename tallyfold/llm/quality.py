"""Document quality by a factorisation machine.

A document is a list of terms: one for each of its words, lower-cased, hashed
and weighted by 1/words, and one for each one-hot bin of its structure
statistics and of the `n_chars` metadata, weighted 1. With x the weights, w the
linear and v the factor parameters of the terms, the score is the logistic of

    b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

so that all pairs of terms interact in time linear in the terms, and the three
sums of a long text add up over its pieces.

The machine is trained by rounds of mini-batch AdaGrad inside tasks whose
parameters are averaged, each weighted by its rows, after every round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts
from tallyfold.session import discard, materialise

#: Upper ends of the bins of each structure statistic; the last bin is open.
BINS = {
    "words": (1, 20, 60, 200, 600, 2000, 8000),
    "mean_word": (2, 3, 4, 5, 6, 8, 12, 30),
    "capitals": (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "digits": (0.001, 0.005, 0.02, 0.05, 0.1, 0.3),
    "marks": (0.01, 0.03, 0.05, 0.08, 0.15, 0.3),
    "same_as_last": (0.002, 0.01, 0.05, 0.15, 0.4, 0.8),
    "short_words": (0.02, 0.1, 0.2, 0.35, 0.6),
    "words_per_line": (2, 5, 10, 25, 60, 200),
    "n_chars": (1, 100, 300, 1000, 3000, 10000, 100000),
}
#: Each statistic has a bin for null besides.
WIDTH = {name: len(ends) + 2 for name, ends in BINS.items()}
N_BINS = sum(WIDTH.values())

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK[48:58] = _MARK[65:91] = _MARK[97:123] = False


@dataclass
class Machine:
    """Words hash to 2**bits slots; the bins of the statistics follow them."""

    bits: int
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    @staticmethod
    def new(bits: int, rank: int, seed: int = 7) -> Machine:
        size = (1 << bits) + N_BINS
        factors = np.random.default_rng(seed).normal(0, 0.02, (size, rank))
        return Machine(bits, 0.0, np.zeros(size, np.float32), factors.astype(np.float32))


def _sums(block: texts.Block, flags: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[block.offsets[1:]] - total[block.offsets[:-1]]


def _hashed(block: texts.Block, bits: int) -> tuple[texts.Words, np.ndarray, np.ndarray]:
    """Words of a block, the slot of each, and what the statistics of its pieces sum up."""
    found = texts.words(block)
    raw = texts.hashes(texts.LOWER[block.data], found.starts, found.ends)
    slots = (raw >> np.uint64(64 - bits)).astype(np.int64)
    n = len(block.rows)
    same = np.zeros(len(raw), bool)
    same[1:] = (raw[1:] == raw[:-1]) & (found.piece[1:] == found.piece[:-1])
    length = found.ends - found.starts
    parts = np.stack(
        [
            found.per_piece(n),
            np.bincount(found.piece, length, n),
            _sums(block, _CAPITAL[block.data]),
            _sums(block, _DIGIT[block.data]),
            _sums(block, _MARK[block.data]),
            np.bincount(found.piece[same], minlength=n),
            np.bincount(found.piece[length <= 2], minlength=n),
            _sums(block, block.data == 10),
        ],
        axis=1,
    ).astype(np.float64)
    return found, slots, parts


def _bins(total: np.ndarray, n_chars: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each statistic for each row."""
    words, size, capitals, digits, marks, same, short, breaks = total.T
    each, byte = np.maximum(words, 1), np.maximum(size, 1)
    values = [
        words,
        size / each,
        capitals / byte,
        digits / byte,
        marks / byte,
        same / each,
        short / each,
        words / (breaks + 1),
        n_chars,
    ]
    out, first = [], 1 << bits
    for (name, ends), x in zip(BINS.items(), values, strict=True):
        out.append(first + np.where(np.isnan(x), len(ends) + 1, np.searchsorted(ends, x, "right")))
        first += WIDTH[name]
    return np.stack(out, axis=1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _score(machine: Machine, column: pa.Array, n_chars: np.ndarray) -> np.ndarray:
    """Probabilities of label 1; the linear, factor and square sums of long texts add up over their pieces."""
    n, rank = len(n_chars), machine.factors.shape[1]
    both = np.concatenate([machine.weight[:, None], machine.factors], axis=1)
    squares = (machine.factors.astype(np.float64) ** 2).sum(axis=1)
    linear, squared, total = np.zeros((n, 1 + rank)), np.zeros(n), np.zeros((n, 8))
    for block in texts.blocks(column):
        found, slots, parts = _hashed(block, machine.bits)
        np.add.at(total, block.rows, parts)
        if len(slots):
            edges = np.flatnonzero(np.diff(found.piece, prepend=-1))
            rows = block.rows[found.piece[edges]]
            np.add.at(linear, rows, np.add.reduceat(both[slots], edges, axis=0, dtype=np.float64))
            np.add.at(squared, rows, np.add.reduceat(squares[slots], edges))
    share = 1 / np.maximum(total[:, :1], 1)
    linear *= share
    squared *= share[:, 0] ** 2
    bins = _bins(total, n_chars, machine.bits)
    linear += both[bins].sum(axis=1, dtype=np.float64)
    squared += squares[bins].sum(axis=1)
    margin = machine.bias + linear[:, 0] + 0.5 * ((linear[:, 1:] ** 2).sum(axis=1) - squared)
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def features(df: DataFrame, text: str, n_chars: str, label: str, key: str, bits: int) -> DataFrame:
    """(key, label, slots, bins): the slots of all words of each labelled text."""
    rows = df.select(F.col(text), F.col(n_chars).cast("double"), F.col(label).cast("int"), F.col(key).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            total, slots, of = np.zeros((n, 8)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in texts.blocks(batch.column(0)):
                found, found_slots, parts = _hashed(block, bits)
                np.add.at(total, block.rows, parts)
                slots.append(found_slots)
                of.append(block.rows[found.piece])
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(of), minlength=n))])
            bins = _bins(total, _numbers(batch.column(1)), bits)
            flat = pa.array(np.concatenate(slots).astype(np.int32))
            yield pa.record_batch(
                {
                    "key": batch.column(3),
                    "label": batch.column(2),
                    "slots": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat),
                    "bins": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, bins.size + 1, bins.shape[1], dtype=np.int32)),
                        pa.array(bins.ravel().astype(np.int32)),
                    ),
                }
            )

    return rows.mapInArrow(run, "key string, label int, slots array<int>, bins array<int>")


def _terms(words: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots of a text, each once, the sum of the weights of its terms, and that of their squares."""
    slot, n = np.unique(words, return_counts=True)
    share, one = 1 / max(1, len(words)), np.ones(len(bins))
    at = np.concatenate([slot, bins]).astype(np.int64)
    return at, np.concatenate([n * share, one]), np.concatenate([n * share**2, one])


def _epoch(machine: Machine, rows: pd.DataFrame, epochs: int, rate: float, seed: int) -> Machine:
    """AdaGrad over the rows of a task in mini-batches."""
    weight, factors, bias = machine.weight.astype(np.float64), machine.factors.astype(np.float64), machine.bias
    g_weight, g_factors, g_bias = np.full(len(weight), 1e-2), np.full(factors.shape, 1e-2), 1e-2
    labels = rows["label"].to_numpy(float)
    terms = [_terms(words, bins) for words, bins in zip(rows["slots"], rows["bins"], strict=True)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for some in np.array_split(order, max(1, len(order) // 16)):
            at, x, square = (np.concatenate(parts) for parts in zip(*[terms[r] for r in some], strict=True))
            n, size = len(some), np.array([len(terms[r][0]) for r in some])
            of = np.repeat(np.arange(n), size)
            total = np.add.reduceat(factors[at] * x[:, None], np.cumsum(size) - size, axis=0)
            margin = bias + np.bincount(of, weight[at] * x, n) + 0.5 * (total**2).sum(axis=1)
            margin -= 0.5 * np.bincount(of, (factors[at] ** 2).sum(axis=1) * square, n)
            error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[some]) / n
            slope = error[of] * x
            d_factors = error[of][:, None] * (x[:, None] * total[of] - square[:, None] * factors[at])
            by_slot = np.argsort(at, kind="stable")
            first = np.flatnonzero(np.diff(at[by_slot], prepend=-1))
            used = at[by_slot[first]]
            d_weight = np.add.reduceat(slope[by_slot], first) + 1e-5 * weight[used]
            d_used = np.add.reduceat(d_factors[by_slot], first, axis=0) + 1e-5 * factors[used]
            g_weight[used] += d_weight**2
            g_factors[used] += d_used**2
            weight[used] -= rate * d_weight / np.sqrt(g_weight[used])
            factors[used] -= rate * d_used / np.sqrt(g_factors[used])
            g_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(g_bias)
    return Machine(machine.bits, bias, weight.astype(np.float32), factors.astype(np.float32))


def _learner(sent: Broadcast, epochs: int, rate: float, seed: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """For applyInPandas: the parameters that a task's rows make of those sent."""

    def learn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", kind="stable", ignore_index=True)
        got = _epoch(sent.value, pdf, epochs, rate, seed + int(key[0]))
        both = np.concatenate([got.weight, got.factors.ravel(), [np.float32(got.bias)]]).astype(np.float32)
        return pd.DataFrame({"task": [key[0]], "rows": [len(pdf)], "parameters": [both.tobytes()]})

    return learn


def train(
    df: DataFrame,
    text: str = "text",
    n_chars: str = "n_chars",
    label: str = "quality",
    key: str = "doc_id",
    sample: int = 12_000,
    bits: int = 16,
    rank: int = 8,
    rows_per_task: int = 1500,
    rounds: int = 3,
    visits: int = 72_000,
    rate: float = 0.1,
) -> Machine:
    """A machine learned from about `sample` labelled rows, picked by the hash of their key; fewer give all.

    All rounds together visit about `visits` rows, whatever their number. Rows
    without label are left out, null texts count as empty. No rows give the
    machine that scores everything 0.5. Reruns over the same rows agree.
    """
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull())
    n = rows.count()
    machine = Machine.new(bits, rank)
    if not n:
        return machine
    steps = 1 << 24
    picked = rows.where(F.pmod(F.xxhash64(key), F.lit(steps)) < int(min(1, sample / n) * steps))
    data = materialise(features(picked, text, n_chars, label, key, bits), "quality-sample")
    n = min(n, sample)
    tasks, epochs = -(-n // rows_per_task), max(1, round(visits / rounds / n))
    dealt = data.groupBy(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"))
    for r in range(rounds):
        learn = _learner(spark.sparkContext.broadcast(machine), epochs, rate / (r + 1), 97 * r)
        parts = dealt.applyInPandas(learn, "task long, rows long, parameters binary").collect()
        parts = sorted(parts, key=lambda part: part["task"])
        mean = sum(np.frombuffer(p["parameters"], np.float32).astype(np.float64) * p["rows"] for p in parts)
        mean = (mean / sum(p["rows"] for p in parts)).astype(np.float32)
        size = len(machine.weight)
        machine = Machine(bits, float(mean[-1]), mean[:size], mean[size:-1].reshape(size, rank))
    discard(data)
    return machine


def score(
    df: DataFrame,
    machine: Machine,
    text: str = "text",
    n_chars: str = "n_chars",
    score: str = "score",
    predicted: str = "predicted",
    threshold: float = 0.3,
) -> DataFrame:
    """The frame with the probability of label 1 and whether it reaches the threshold.

    Null and empty texts are scored by their statistics alone. Columns of the
    result's names are replaced.
    """
    kept = [c for c in df.columns if c not in (score, predicted)]
    schema = texts.extended(df.select(*kept).schema, **{score: "double", predicted: "int"})
    rows = df.select(*kept, F.col(text).alias("_text"), F.col(n_chars).cast("double").alias("_n_chars"))
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _score(sent.value, batch.column(len(kept)), _numbers(batch.column(len(kept) + 1)))
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, score, predicted])

    return rows.mapInArrow(run, schema)
