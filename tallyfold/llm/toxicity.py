"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

A unit is a word, or a run of three and more single characters, which is read
as one word. Its symbols are a-z (a few look-alike digits and signs among
them), the low bits of other letters' bytes, and marks for its start and end;
other bytes are skipped. The kernel of two units is the gap-weighted sum over
all subsequences of three symbols that both hold, DECAY to the length each one
spans, at most SPAN symbols, divided by what the lengths of both units alone
make of it. So inserted characters only weaken a match.

Landmarks are units; by Nystroem's method the kernel is projected on their span,
in which a linear machine with squared hinge loss is trained. Its weight vector
is a sum of landmarks, hence a number for each subsequence: a unit is scored by
looking up its own ones, whatever the number of landmarks.

Labels belong to texts, so training is for several instances: a toxic text has
at least one unit that bears its label out, its best scored one, and all units
of other texts are negative. A text's score is the logistic of its best unit,
of the number of positive units and of its length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts

DECAY, SPAN = 0.7, 7
SYMBOLS = 64
START, END = 59, 60
#: Longer units are read as several that overlap by SPAN symbols, so that no subsequence is lost.
LONGEST = 40

#: The symbol of each byte, 0 for bytes that are skipped.
SYMBOL = np.zeros(256, np.int32)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)
for _sign, _letter in zip("013457@", "oieasta", strict=True):
    SYMBOL[ord(_sign)] = ord(_letter) - 96
SYMBOL[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) & 31)

_GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


def _weights(length: int) -> float:
    """The squared norm that units of this length have, equal subsequences counted apart."""
    return sum(max(0, length - a - b) * DECAY ** (2 * (a + b + 1)) for a, b in _GAPS)


_NORM = np.array([1 / np.sqrt(max(_weights(n), 1e-9)) if n >= 3 else 0.0 for n in range(LONGEST + 3)])


@dataclass
class Units:
    """Symbols of units, one after the other, start and end marks included; unit i ends before ends[i]."""

    symbols: np.ndarray
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends]).astype(np.int64)[:-1]

    def bytes(self) -> list[bytes]:
        flat = self.symbols.astype(np.uint8).tobytes()
        return [flat[a:b] for a, b in zip(self.starts, self.ends, strict=True)]

    @staticmethod
    def of(units: list[bytes]) -> Units:
        symbols = np.frombuffer(b"".join(units), np.uint8).astype(np.int32)
        return Units(symbols, np.cumsum([len(u) for u in units], dtype=np.int64))

    def subsequences(self) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each pair of gaps: where subsequences start, their codes, and their weight."""
        n = len(self.symbols)
        left = np.repeat(self.ends, np.diff(self.ends, prepend=0)) - np.arange(n)
        for a, b in _GAPS:
            at = np.flatnonzero(left > a + b)
            code = (self.symbols[at] * SYMBOLS + self.symbols[at + a]) * SYMBOLS + self.symbols[at + a + b]
            yield at, code, DECAY ** (a + b + 1)

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Sums of the table's rows at each unit's subsequences, weighted and normed."""
        total = np.zeros((len(self.symbols), *table.shape[1:]))
        for at, code, weight in self.subsequences():
            total[at] += weight * table[code]
        if not len(self.ends):
            return total
        length = np.diff(self.ends, prepend=0)
        norm = _NORM[length].reshape(-1, *[1] * (table.ndim - 1))
        return np.add.reduceat(total, self.starts, axis=0) * norm


def units(block: texts.Block) -> tuple[Units, np.ndarray, np.ndarray]:
    """The distinct units of a block, and for each occurrence its unit and piece."""
    found = texts.words(block)
    symbol = SYMBOL[block.data]
    solid = np.concatenate([[0], np.cumsum(symbol > 0)])
    length = solid[found.ends] - solid[found.starts]
    # runs of single symbols within a piece become one unit
    single = length == 1
    joins = single.copy()
    joins[1:] &= single[:-1] & (found.piece[1:] == found.piece[:-1])
    joins[:1] = False
    run = np.cumsum(~joins) - 1
    size = np.bincount(run, minlength=int(run[-1]) + 1 if len(run) else 0)
    short = (size == 2)[run]
    head = ~joins | short
    starts, piece = found.starts[head], found.piece[head]
    last = np.flatnonzero(np.append(head[1:], True)) if len(head) else np.zeros(0, np.int64)
    ends = found.ends[last]
    kept = symbol > 0
    place = np.cumsum(kept) - kept
    symbols = symbol[kept].astype(np.uint8)
    a, b = place[starts] if len(starts) else starts, solid[ends]
    parts = 1 + np.maximum(0, -(-(b - a - LONGEST) // (LONGEST - SPAN)))
    whole = np.repeat(np.arange(len(a)), parts)
    part = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
    a, b, piece = a[whole] + part * (LONGEST - SPAN), b[whole], piece[whole]
    b = np.minimum(b, a + LONGEST)
    keys = texts.hashes(symbols, a, b) if len(a) else np.zeros(0, np.uint64)
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    a, b = a[first], b[first]
    size = b - a + 2
    out_ends = np.cumsum(size)
    out = np.full(int(out_ends[-1]) if len(out_ends) else 0, END, np.int32)
    out[out_ends - size] = START
    inside = np.arange(int((b - a).sum())) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
    out[np.repeat(out_ends - size + 1, b - a) + inside] = symbols[np.repeat(a, b - a) + inside]
    return Units(out, out_ends), of, piece


@dataclass
class Machine:
    """A number for each subsequence, the machine's intercept, and the logistic's parameters for a text."""

    table: np.ndarray
    bias: float
    text: np.ndarray

    def measures(self, column: pa.Array) -> np.ndarray:
        """For each row: 1, its best unit, log of 1 and positive units, log of 1 and all units."""
        n = len(column)
        best, positive, every = np.full(n, -3.0), np.zeros(n), np.zeros(n)
        for block in texts.blocks(column):
            found, of, piece = units(block)
            if not len(of):
                continue
            score = (found.scores(self.table) + self.bias)[of]
            edges = np.flatnonzero(np.diff(piece, prepend=-1))
            rows = block.rows[piece[edges]]
            best[rows] = np.maximum(best[rows], np.maximum.reduceat(score, edges))
            positive += np.bincount(block.rows[piece], score > 0, n)
            every += np.bincount(block.rows[piece], minlength=n)
        return np.stack([np.ones(n), np.clip(best, -3, 3), np.log1p(positive), np.log1p(every)], axis=1)

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.measures(column) @ self.text, -500, 500)))


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last column of x is the intercept's."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(30):
        slack = 1 - y * (x @ w)
        on = slack > 0
        grad = penalty * w - x[on].T @ (weight[on] * y[on] * slack[on])
        hess = np.diag(penalty) + (x[on] * weight[on][:, None]).T @ x[on]
        step = np.linalg.solve(hess + 1e-9 * np.eye(len(w)), grad)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = ridge * w - x.T @ (weight * (y - p))
        hess = ridge * np.eye(len(w)) + (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def nystroem(landmarks: Units, instances: Units, y: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Train on the instances in the span of the landmarks; the weight of each subsequence, and the intercept."""
    m = len(landmarks.ends)
    grams = np.zeros((SYMBOLS**3, m), np.float32)
    owner = np.repeat(np.arange(m), np.diff(landmarks.ends, prepend=0))
    norm = _NORM[np.diff(landmarks.ends, prepend=0)]
    for at, code, w in landmarks.subsequences():
        np.add.at(grams, (code, owner[at]), w * norm[owner[at]])
    among = landmarks.scores(grams)
    value, vector = np.linalg.eigh((among + among.T) / 2)
    keep = value > 1e-6 * max(value.max(), 1e-9)
    whiten = vector[:, keep] / np.sqrt(value[keep])
    parts = []
    for at in range(0, len(instances.ends), 4096):
        low = instances.ends[at - 1] if at else 0
        ends = instances.ends[at : at + 4096]
        parts.append(Units(instances.symbols[low : ends[-1]], ends - low).scores(grams) @ whiten)
    x = np.concatenate(parts)
    w = hinge(np.concatenate([x, np.ones((len(x), 1))], axis=1), y, weight, ridge)
    return (grams @ (whiten @ w[:-1]).astype(np.float32)).astype(np.float64), float(w[-1])


def _sampled(df: DataFrame, text: str, label: str, key: str, toxic: int, clean: int) -> tuple[pa.Table, dict[int, float]]:
    """Sampled texts, and by label how many each stands for."""
    rows = df.where(F.col(label).isin(0, 1)).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"), F.col(key).alias("key"))
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    steps = 1 << 24
    share = {k: min(1.0, most / max(1, sizes.get(k, 0))) for k, most in ((0, clean), (1, toxic))}
    spot = F.pmod(F.xxhash64("key"), F.lit(steps))
    # the first condition is on the key alone, so that it goes below a join with the labels
    picked = rows.where(spot < int(max(share.values()) * steps)).where(spot < F.when(F.col("label") == 1, int(share[1] * steps)).otherwise(int(share[0] * steps)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            order = batch.column(2).cast(pa.string())
            for row in range(batch.num_rows):
                held: Counter[bytes] = Counter()
                for block in texts.blocks(batch.column(0).slice(row, 1)):
                    found, of, _ = units(block)
                    held.update(dict(zip(found.bytes(), np.bincount(of, minlength=len(found.ends)).tolist(), strict=True)))
                yield pa.record_batch(
                    {
                        "label": pa.array([label[row]], pa.int32()),
                        "key": order.slice(row, 1),
                        "units": pa.array([sorted(held)], pa.list_(pa.binary())),
                        "times": pa.array([[held[u] for u in sorted(held)]], pa.list_(pa.int64())),
                    }
                )

    sample = picked.mapInArrow(run, "label int, key string, units array<binary>, times array<long>").toArrow()
    return sample.sort_by("key"), {k: 1 / share[k] for k in share}


def train(
    df: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    toxic: int = 2000,
    clean: int = 3000,
    landmarks: int = 160,
    rounds: int = 4,
    ridge: float = 1.0,
    seed: int = 3,
    hard: int = 4000,
    common: int = 2000,
    others: int = 14000,
    votes_at_most: int = 20,
) -> Machine:
    """A machine learned from about so many whole texts of either label, picked by the hash of their key.

    Of the units of the sampled clean texts a round learns from the `hard` ones
    that score highest, the `common` ones that most texts hold, and `others` drawn
    at random; a toxic unit counts `votes_at_most` times at most, however many
    texts it is the witness of. Fewer give all. Rows without label are left out and null texts are empty.
    Without texts of both labels every text scores the share of label 1, or 0.5
    without any. Reruns over the same rows agree.
    """
    sample, stands = _sampled(df, text, label, key, toxic, clean)
    labels = sample.column("label").to_numpy()
    blank = np.zeros(SYMBOLS**3)
    if not len(labels) or labels.min() == labels.max():
        level = 0.0 if not len(labels) else 7.0 * (2 * labels[0] - 1)
        return Machine(blank, 0.0, np.array([level, 0.0, 0.0, 0.0]))
    column = sample.column("units").combine_chunks()
    text_of = np.repeat(np.arange(len(labels)), np.diff(column.offsets.to_numpy()))
    unit_of, types = pd.factorize(np.array(column.flatten().to_pylist(), dtype=object))
    y = labels[text_of]
    in_toxic, in_clean = np.bincount(unit_of[y == 1], minlength=len(types)), np.bincount(unit_of[y == 0], minlength=len(types))
    n_toxic, n_clean = int((labels == 1).sum()), int((labels == 0).sum())
    every = Units.of(list(types))
    odds = np.log((in_toxic + 0.1) / (n_toxic + 0.2)) - np.log((in_clean + 0.5) / (n_clean + 1))
    score = odds * np.sqrt(in_toxic)
    rng = np.random.default_rng(seed)
    pick = y == 1
    order = np.argsort(text_of[pick], kind="stable")
    held, owner = unit_of[pick][order], text_of[pick][order]
    edges = np.flatnonzero(np.diff(owner, prepend=-1))
    clean_types = np.flatnonzero(in_clean > 0)
    machine = Machine(blank, 0.0, np.zeros(4))
    for r in range(rounds):
        # a toxic text's witness, and its other units that score as high as witnesses do
        top = np.maximum.reduceat(score[held], edges)
        limit = np.repeat(top, np.diff(np.append(edges, len(held))))
        floor = 1.0 if r else np.quantile(top, 0.25)
        witness = (score[held] >= limit) | ((score[held] >= floor) & (in_clean[held] == 0))
        votes = np.bincount(held[witness], minlength=len(types)).astype(float)
        positive = np.flatnonzero(votes > 0)
        highest = clean_types[np.argsort(-score[clean_types], kind="stable")[:hard]]
        frequent = clean_types[np.argsort(-in_clean[clean_types], kind="stable")[:common]]
        drawn = rng.choice(clean_types, min(others, len(clean_types)), replace=False)
        negative = np.setdiff1d(np.concatenate([highest, frequent, drawn]), positive[in_clean[positive] * 5 < in_toxic[positive]])
        positive = np.setdiff1d(positive, negative)
        if not len(positive):
            break
        half = landmarks // 2
        marks = positive[np.argsort(-votes[positive], kind="stable")[:half]]
        marks = np.concatenate([marks, highest[: half // 2], rng.choice(negative, min(half // 2, len(negative)), replace=False)])
        chosen = np.concatenate([positive, negative])
        sign = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        weight = np.concatenate([np.minimum(votes[positive], votes_at_most), np.ones(len(negative))])
        weight[: len(positive)] *= len(negative) / max(1.0, weight[: len(positive)].sum()) / 4
        units_of = lambda at: Units.of([types[i] for i in at])
        table, bias = nystroem(units_of(np.unique(marks)), units_of(chosen), sign, weight, ridge)
        machine = Machine(table, bias, np.zeros(4))
        score = every.scores(table) + bias
    best = np.full(len(labels), -3.0)
    np.maximum.at(best, text_of, score[unit_of])
    times = sample.column("times").combine_chunks().flatten().to_numpy()
    positives = np.bincount(text_of, times * (score[unit_of] > 0), len(labels))
    size = np.bincount(text_of, times, len(labels))
    x = np.stack([np.ones(len(labels)), np.clip(best, -3, 3), np.log1p(positives), np.log1p(size)], axis=1)
    weight = np.where(labels == 1, stands[1], stands[0])
    machine.text = logistic(x, labels.astype(float), weight * len(labels) / weight.sum())
    return machine


def score(
    df: DataFrame,
    machine: Machine,
    text: str = "text",
    score: str = "score",
    predicted: str = "predicted",
    threshold: float = 0.3,
) -> DataFrame:
    """The frame with the probability of label 1 and whether it reaches the threshold.

    Null and empty texts are scored by having no unit. Columns of the result's
    names are replaced.
    """
    kept = [c for c in df.columns if c not in (score, predicted)]
    schema = texts.extended(df.select(*kept).schema, **{score: "double", predicted: "int"})
    rows = df.select(*kept, F.col(text).alias("_text"))
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = sent.value.score(batch.column(len(kept)))
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, score, predicted])

    return rows.mapInArrow(run, schema)
