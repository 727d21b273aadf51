"""Fill-in-the-middle forms of texts, by whole-column Arrow operations.

A text is cut into lines. All lines of a batch are one flat array with the row
and the ordinal of each; two cuts give a line its role (prefix, middle or
suffix), the lines of a role are filtered out, made lists again and joined.
Nothing is done for a single row, and a batch is worked on in slices of bounded
bytes, so only a text longer than that makes a longer slice.

The draws of a row are the first 8-digit groups of the hex sha256 of "<seed>:<key>",
so the forms depend on the key alone, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.texts import extended

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text that are worked on together.
SLICE = 1 << 24
_NEW = ("n", "form", "output", "prefix_chars", "middle_chars")


def draws(key: Column, seed: int, n: int = 4) -> Column:
    """The first n 8-digit groups of the sha256 of seed and key, as longs; a null key is ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digits = F.sha2(text.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most SLICE bytes of a string column, a row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(size, done + SLICE, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _modulo(x: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, by), by))


def lines(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """All lines with their line breaks, the row and the ordinal of each, and the number of lines of each row."""
    pieces = pc.split_pattern(texts, "\n")
    flat, parent = pieces.flatten(), pc.list_parent_indices(pieces).cast(pa.int64())
    size = pc.list_value_length(pieces).cast(pa.int64())
    first = pc.subtract(pc.cumulative_sum(size), size)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(first, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(size, parent), 1))
    flat = pc.binary_join_element_wise(flat, pc.if_else(last, "", "\n").cast(flat.type), pa.scalar("", flat.type))
    # behind a final line break, and in an empty text, there is no line
    some = pc.greater(pc.binary_length(flat), 0)
    ended = pc.or_(pc.ends_with(texts, "\n"), pc.equal(pc.binary_length(texts), 0))
    return flat.filter(some), parent.filter(some), ordinal.filter(some), pc.subtract(size, ended.cast(pa.int64()))


def _joined(flat: pa.Array, chosen: pa.Array, size: pa.Array) -> pa.Array:
    """The chosen lines joined row by row; size: how many each row has of them."""
    ends = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False))])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.filter(chosen))
    return pc.binary_join(lists, pa.scalar("", flat.type))


def _forms(texts: pa.Array, draws: pa.Array, rate: int, spm: int) -> list[pa.Array]:
    """The columns of _NEW for texts without nulls."""
    h = [pc.list_element(draws, i) for i in range(4)]
    flat, parent, ordinal, n = lines(texts)
    cuts = [_modulo(x, pc.add(n, 1)) for x in h[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    before, inside = pc.less(ordinal, pc.take(low, parent)), pc.less(ordinal, pc.take(high, parent))
    prefix = _joined(flat, before, low)
    middle = _joined(flat, pc.and_not(inside, before), pc.subtract(high, low))
    suffix = _joined(flat, pc.invert(inside), pc.subtract(n, high))
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_modulo(h[2], 100), rate))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    late = pc.less(_modulo(h[3], 100), spm)
    p, s, m, nothing = (pa.scalar(x, texts.type) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing)
    spm_form = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing)
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x).cast(pa.int64())) for x in (prefix, middle)]
    form = pc.if_else(plain, "plain", pc.if_else(late, "spm", "psm"))
    return [n, form, pc.if_else(plain, texts, pc.if_else(late, spm_form, psm)), *chars]


def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts that outputs were made from. A marker stands nowhere but where the form puts it."""
    text = output.type

    def halves(column: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
        both = pc.split_pattern(column, mark, max_splits=1)
        return pc.list_element(both, 0), pc.list_element(both, 1)

    def rebuilt(first: str, second: str, name: str) -> tuple[pa.Array, dict[str, pa.Array], pa.Array]:
        mine = pc.equal(form, name)
        rest, middle = halves(pc.if_else(mine, output, pa.scalar(first + second + MIDDLE, text)), MIDDLE)
        one, two = halves(rest, second)
        return mine, {first: halves(one, first)[1], second: two}, middle

    out = output
    for first, second, name in ((PREFIX, SUFFIX, "psm"), (SUFFIX, PREFIX, "spm")):
        mine, part, middle = rebuilt(first, second, name)
        out = pc.if_else(mine, pc.binary_join_element_wise(part[PREFIX], middle, part[SUFFIX], pa.scalar("", text)), out)
    return out


def transform(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm: int = 50
) -> DataFrame:
    """The rows with n, form, output, prefix_chars and middle_chars, which replace columns of those names.

    n is the number of lines. `rate` percent of the texts are transformed and
    `spm` percent of those begin with the suffix. Empty and null texts and texts
    that hold a marker are plain: output is the text, '' for null, and the
    lengths are null. Equal keys draw alike, a null key draws as ''.
    """
    kept = [c for c in df.columns if c not in _NEW]
    rows = df.select(*kept, F.col(text).cast("string").alias("_fim_text"), draws(F.col(key), seed).alias("_fim_draws"))
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, at):
                texts = pc.fill_null(part.column(at).cast(pa.string()), "")
                made = _forms(texts, part.column(at + 1), rate, spm)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *made], [*kept, *_NEW])

    schema = extended(df.select(*kept).schema, n="long", form="string", output="string", prefix_chars="long", middle_chars="long")
    return rows.mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form", restored: str = "restored") -> DataFrame:
    """The rows with the text rebuilt from output and form; null outputs are ''."""
    kept = [c for c in df.columns if c != restored]
    rows = df.select(*kept, F.col(output).alias("_fim_output"), F.coalesce(F.col(form), F.lit("plain")).alias("_fim_form"))
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, at):
                outputs = pc.fill_null(part.column(at).cast(pa.string()), "")
                made = _restored(outputs, part.column(at + 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], made], [*kept, restored])

    return rows.mapInArrow(run, extended(df.select(*kept).schema, **{restored: "string"}))


def sql(seed: int = 7, rate: int = 100, spm: int = 50) -> str:
    """For DuckDB, the digests of the transformed documents and of the texts rebuilt from the cuts."""
    h = ", ".join(f"('0x' || substr(d, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    return rf"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
            sha256('{seed}:' || doc_id) AS d
        FROM documents
    ),
    drawn AS (SELECT doc_id, t, u, len(u) AS n, {h} FROM cut),
    placed AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {rate}
                THEN 'plain' WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form
        FROM drawn
    ),
    parted AS (
        SELECT *, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m,
            array_to_string(u[hi + 1:n], '') AS s
        FROM placed
    )
    SELECT doc_id, n::BIGINT AS n, form,
        CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
    FROM parted
    """
