"""Texts as byte arrays inside tasks.

An Arrow string column is one run of bytes with an offset for each row. The
helpers here cut such columns into blocks of bounded size, so that numpy work
on whole texts needs bounded memory whatever the length of a text: a text
longer than a block is handed out in several pieces of the same row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass
class Block:
    """Pieces of texts. Piece i is data[offsets[i]:offsets[i+1]] and belongs to rows[i].

    The first lead[i] bytes of a piece repeat the end of the piece before it.
    """

    data: np.ndarray
    offsets: np.ndarray
    rows: np.ndarray
    lead: np.ndarray

    def nonempty(self) -> np.ndarray:
        return np.flatnonzero(np.diff(self.offsets) > 0)

    def sums(self, values: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Sums of the values by piece; at: positions of the values in data, if not all."""
        if at is None:
            ends = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
            return ends[self.offsets[1:]] - ends[self.offsets[:-1]]
        piece = np.searchsorted(self.offsets, at, "right") - 1
        return np.bincount(piece, values, len(self.rows))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def blocks(column: pa.Array, limit: int = BLOCK, lead: int = 0) -> Iterator[Block]:
    """Blocks of about `limit` bytes at most, over all bytes of all rows.

    Without `lead`, a long text is cut behind white space, so that words stay
    whole; only a word longer than a block makes a longer one. With `lead`, it
    is cut anywhere and each later piece repeats so many bytes.
    """
    data, offsets = utf8(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        if last > first:
            a, b = offsets[first], offsets[last]
            yield Block(data[a:b], offsets[first : last + 1] - a, np.arange(first, last), np.zeros(last - first, np.int64))
            first = last
            continue
        start, end = int(offsets[first]), int(offsets[first + 1])
        at = start
        while at < end:
            stop = min(end, at + limit)
            if stop < end and not lead:
                gaps = np.flatnonzero(SPACE[data[at:stop]])
                if len(gaps):
                    stop = at + int(gaps[-1]) + 1
                else:
                    gaps = np.flatnonzero(SPACE[data[stop:end]])
                    stop = stop + int(gaps[0]) + 1 if len(gaps) else end
            back = min(lead, at - start)
            piece = data[at - back : stop]
            yield Block(piece, np.array([0, len(piece)]), np.array([first]), np.array([back]))
            at = stop
        first += 1


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Runs of bytes that are no gaps: where they start and end, and their piece."""

    starts: np.ndarray
    ends: np.ndarray
    piece: np.ndarray

    def per_piece(self, n: int) -> np.ndarray:
        return np.bincount(self.piece, minlength=n)


def words(block: Block, gap: np.ndarray = SPACE) -> Words:
    solid = ~gap[block.data]
    n = len(solid)
    before, behind = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], behind[:-1] = solid[:-1], solid[1:]
    some = block.nonempty()
    before[block.offsets[some]] = False
    behind[block.offsets[some + 1] - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~behind) + 1
    return Words(starts, ends, np.searchsorted(block.offsets, starts, "right") - 1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs; equal runs have equal hashes wherever they stand."""
    size = max(BLOCK + 1, 1 << int(len(data)).bit_length())
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def extended(schema: T.StructType, **kinds: str) -> T.StructType:
    """The schema with further columns, given by their DDL types."""
    more = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return T.StructType([*schema.fields, *more])


def learned(doc_id: Column, divisor: int, held: int) -> Column:
    """Whether a document is not held out: crc32(doc_id as text) mod divisor is not `held`; a null id is ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor != held
