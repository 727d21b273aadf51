"""Exact top-k inner products by elimination with a pivot table.

Components become integers. Pivots are picked farthest-first on a bounded
sample; the distances of every vector to all pivots are its row of the pivot
table. Candidates lie in cells of neighbours in that table, and for a query at
distances t to the pivots a cell whose distances span [a, b] is at least

    max over pivots of max(a - t, t - b, 0)

away, which with the lengths of both bounds the inner product from above. Each
query visits cells in the order of that bound, starting with the score that the
sample guarantees, and stops when the bound falls below its k-th best score.
Within a cell all inner products are computed, exactly.

Queries and candidates are dealt into blocks of neighbours of bounded size. The
spans of both blocks' distances bound all their products at once, so that only
blocks that can hold a result are brought together; a task holds one of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.inputs import sent as sent_side
from tallyfold.session import materialise

PIVOTS = 32
SAMPLE = 8192
BLOCK = 2048
CELL = 128


def scaled(column: pa.Array, factor: float) -> pa.Array:
    """floor(factor * x) of each component as packed 64-bit integers; null for vectors that are null or hold null or no finite number.

    Components whose product is beyond 64 bits are the largest or smallest number that is not.
    """
    lists = column.cast(pa.large_list(pa.float64()))
    flat = lists.flatten()
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    x = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(size)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    sound = np.asarray(lists.is_valid()) & (bad[ends[1:]] == bad[ends[:-1]])
    with np.errstate(over="ignore", invalid="ignore"):
        big = np.floor(factor * x)
    whole = np.where(np.abs(big) < 2.0**63, np.nan_to_num(big, nan=0, posinf=0, neginf=0), 0).astype(np.int64)
    whole[big >= 2.0**63] = np.iinfo(np.int64).max
    whole[big <= -(2.0**63)] = np.iinfo(np.int64).min
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(8 * ends), pa.py_buffer(whole)])
    return pc.if_else(pa.array(sound), packed.cast(pa.binary()), pa.scalar(None, pa.binary()))


def matrix(packed: pd.Series | list[bytes], width: int) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    rows = [np.frombuffer(b, np.int64) for b in packed]
    if rows and all(len(r) == width for r in rows):
        return np.stack(rows)
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, exact: in floating point where every sum stays below 2**53, else in integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = x.astype(np.float64), pivots.astype(np.float64)
    squares = (x**2).sum(axis=1)[:, None] + (p**2).sum(axis=1) - 2 * x @ p.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each next pivot is the vector farthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    near = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


class Cells:
    """Candidates of a block, in cells, with what the bounds need."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, pivots: np.ndarray):
        table = _distances(vectors, pivots)
        near = table.argmin(axis=1)
        order = np.lexsort((table[np.arange(len(table)), near], near))
        self.vectors, self.ids, self.rows, table = vectors[order], ids[order], rows[order], table[order]
        self.starts = np.arange(0, len(table), CELL)
        self.low = np.minimum.reduceat(table, self.starts)
        self.high = np.maximum.reduceat(table, self.starts)
        squares = (self.vectors.astype(np.float64) ** 2).sum(axis=1)
        self.square = np.maximum.reduceat(squares, self.starts)

    def bounds(self, query: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products of each query (row) with the vectors of each cell."""
        t = _distances(query, pivots)
        apart = np.zeros((len(query), len(self.starts)))
        for p in range(len(pivots)):
            away = np.maximum(self.low[:, p][None, :] - t[:, p : p + 1], t[:, p : p + 1] - self.high[:, p][None, :])
            np.maximum(apart, away, out=apart)
        square = (query.astype(np.float64) ** 2).sum(axis=1)[:, None]
        # distances are rounded: the slack covers it many times over
        return (square + self.square - apart**2) / 2 + 1e-6 * (square + self.square + 1)

    def best(self, query: np.ndarray, row: int, bounds: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the query's k best candidates here that reach `least`; ties to smaller ids."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(-bounds, kind="stable")
        at, step = 0, 1
        while at < len(order) and bounds[order[at]] >= least:
            cells = order[at : at + step]
            cells = cells[bounds[cells] >= least]
            some = (self.starts[cells][:, None] + np.arange(CELL)).ravel()
            some = some[some < len(self.ids)]
            new = products(query[None, :], self.vectors[some])[0]
            keep = (new >= least) & (self.rows[some] != row)
            ids, scores = np.concatenate([ids, self.ids[some[keep]]]), np.concatenate([scores, new[keep]])
            if len(ids) > k:
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
            if len(ids) == k:
                least = max(least, int(scores.min()))
            at, step = at + step, step * 2
        return ids, scores


def spans(rows: DataFrame, block: str, sent: Broadcast, width: int) -> DataFrame:
    """(block, pivot, low, high, square, least): by pivot, what the distances of a block's vectors span.

    square is the largest squared length in the block, least the lowest of its rows' `least`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = sent.value[0]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = matrix(part.column(1).to_pylist(), width)
                table = _distances(x, pivots)
                squares = (x.astype(np.float64) ** 2).sum(axis=1)
                names, of = np.unique(part.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
                order = np.argsort(of, kind="stable")
                first = np.searchsorted(of[order], np.arange(len(names)))
                over = lambda f, values: f.reduceat(values[order], first)
                low, high = over(np.minimum, table), over(np.maximum, table)
                yield pa.record_batch(
                    {
                        "block": pa.array(np.repeat(names, len(pivots)), pa.string()),
                        "pivot": np.tile(np.arange(len(pivots)), len(names)),
                        "low": low.ravel(),
                        "high": high.ravel(),
                        "square": np.repeat(over(np.maximum, squares), len(pivots)),
                        "least": np.repeat(over(np.minimum, part.column(2).to_numpy()), len(pivots)),
                    }
                )

    kind = "block string, pivot long, low double, high double, square double, least long"
    found = rows.select(block, "v", "least").mapInArrow(run, kind).groupBy("block", "pivot")
    ends = (F.min("low").alias("low"), F.max("high").alias("high"), F.max("square").alias("square"), F.min("least").alias("least"))
    return materialise(found.agg(*ends), "topk-spans")


def meeting(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(part, block): candidate and query blocks whose bound reaches the least score that a query of the block needs."""
    c = candidates.select(F.col("block").alias("part"), "pivot", "low", "high", "square")
    q = queries.select("block", "pivot", *[F.col(x).alias(f"q_{x}") for x in ("low", "high", "square", "least")])
    away = F.greatest(F.col("low") - F.col("q_high"), F.col("q_low") - F.col("high"), F.lit(0.0))
    pairs = c.join(q, "pivot").groupBy("part", "block")
    pairs = pairs.agg(F.max(away).alias("away"), F.max(F.col("square") + F.col("q_square")).alias("squares"), F.min("q_least").alias("least"))
    # distances are rounded: the slack covers it many times over
    bound = (F.col("squares") - F.col("away") ** 2) / 2 + 1e-6 * (F.col("squares") + 1)
    return pairs.where(bound >= F.col("least")).select("part", "block")


def top(
    df: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    factor: float = 64.0,
    every: int = 20,
) -> DataFrame:
    """(query_id, rank, key, score) of the k best candidates of each query, all if there are fewer.

    Queries are the rows whose key is divisible by `every`; candidates are all
    rows but the query's own. Scores are inner products of floor(factor * x); ties
    go to the smaller key; sums beyond 64 bits are not exact. Vectors that are null, or hold null or a number
    that is not finite, and rows without key take no part. Vectors of different
    lengths are compared as if the shorter ended in zeros.
    """
    spark = df.sparkSession
    slim = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = pa.array(first + np.arange(batch.num_rows))
            first += batch.num_rows
            packed = scaled(batch.column(1), factor)
            out = pa.RecordBatch.from_arrays([rows, batch.column(0), packed], names=["row", "id", "v"])
            yield out.filter(packed.is_valid())

    stored = materialise(slim.mapInArrow(pack, "row long, id long, v binary"), "topk-vectors")
    n, width = stored.agg(F.count("*"), F.coalesce(F.max(F.length("v")) / 8, F.lit(0)).cast("int")).first()
    steps = 1 << 24
    spot = F.pmod(F.xxhash64("row"), F.lit(steps))
    sample = stored.where(spot < int(min(1, SAMPLE / max(n, 1)) * steps)).orderBy("row").select("row", "v").toPandas()
    seen, seen_rows = matrix(list(sample["v"]), width), sample["row"].to_numpy()
    pivots = choose_pivots(seen, PIVOTS)
    sent = spark.sparkContext.broadcast((pivots, seen, seen_rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, seen, seen_rows = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x, ids = matrix(part.column(2).to_pylist(), width), part.column(1).to_numpy()
                cell = _distances(x, pivots).argmin(axis=1) if len(pivots) else np.zeros(len(x), np.int64)
                least = np.full(len(x), np.iinfo(np.int64).min)
                asks = np.flatnonzero(ids % every == 0)
                if len(asks) and len(seen) > k:
                    scores = products(x[asks], seen)
                    own = part.column(0).to_numpy()[asks][:, None] == seen_rows[None, :]
                    scores[own] = np.iinfo(np.int64).min
                    least[asks] = np.partition(scores, len(seen) - k, axis=1)[:, len(seen) - k]
                names = [*part.schema.names, "cell", "least"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(least)], names=names)

    placed = stored.mapInArrow(place, "row long, id long, v binary, cell long, least long")
    placed = materialise(placed, "topk-placed")
    # blocks are parts of a pivot's neighbourhood, of queries as of candidates
    is_query = F.col("id") % every == 0
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"),
        F.ceil(F.count_if(is_query) / BLOCK).cast("long").alias("q_parts"),
    )
    dealt = placed.join(sent_side(sizes), "cell")
    spot = F.pmod(F.xxhash64("row"), F.col("parts"))
    candidates = dealt.withColumn("part", F.concat_ws(":", "cell", spot))
    spot = F.pmod(F.xxhash64("row"), F.col("q_parts"))
    queries = dealt.where(is_query).withColumn("block", F.concat_ws(":", "cell", spot))
    if queries.isEmpty():
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score long")
    grid = materialise(meeting(spans(candidates, "part", sent, width), spans(queries, "block", sent, width)), "topk-grid")
    by = ("block", "part")
    left = candidates.select("row", "id", "v", "part").join(sent_side(grid), "part")
    right = queries.select(*[F.col(c).alias(c) for c in ("row", "id", "v", "least", "block")])
    right = right.join(sent_side(grid).select(*[F.col(c).alias(c) for c in by]), "block")

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        pivots = sent.value[0]
        out: list[pd.DataFrame] = []
        if len(candidates) and len(queries):
            c = matrix(list(candidates["v"]), width)
            cells = Cells(c, candidates["id"].to_numpy(), candidates["row"].to_numpy(), pivots)
            q = matrix(list(queries["v"]), width)
            bounds = cells.bounds(q, pivots)
            for i in np.flatnonzero(bounds.max(axis=1) >= queries["least"].to_numpy()):
                row, least = int(queries["row"].iat[i]), int(queries["least"].iat[i])
                ids, scores = cells.best(q[i], row, bounds[i], least, k)
                out.append(pd.DataFrame({"row": row, "query_id": queries["id"].iat[i], "vec": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame(columns=["row", "query_id", "vec", "score"]).astype("int64")

    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, "row long, query_id long, vec long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec"))
    met = met.withColumn("rank", rank).where(F.col("rank") <= k)
    return met.select("query_id", "rank", F.col("vec").alias(key), "score")
