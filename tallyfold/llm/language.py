"""Language identification by prediction by partial matching.

Each language gets a tree of byte contexts up to `order` bytes long, built from
a sample of its texts and then frozen. A context followed N times by D different
bytes gives a byte seen n times n/(N+D), and escapes to the next shorter context
with D/(N+D); below the empty context all 256 bytes are alike. The code length
of a text under a language is the sum over all its bytes; the shortest wins.
ASCII capitals are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts, trees


def train(
    df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 400, order: int = 3
) -> tuple[list[str], trees.Tree | None]:
    """The languages, ascending, and their frozen trees.

    Learns from about `per_language` whole documents of each language, picked by
    the hash of their key; languages with fewer give all of theirs. Rows without
    text or language are left out; no rows give no languages.
    """
    rows = df.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.col(key).alias("_key"))
    rows = rows.where(F.col("_text").isNotNull() & F.col("_lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("_lang").count().collect()}
    langs = sorted(sizes, key=lambda x: x.encode())
    if not langs:
        return [], None
    steps = 1 << 24
    picked = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(min(1, per_language / sizes[k]) * steps)))])
    number = F.create_map(*[x for i, k in enumerate(langs) for x in (F.lit(k), F.lit(i))])
    sample = rows.where(F.pmod(F.xxhash64("_key"), F.lit(steps)) < picked[F.col("_lang")]).select(
        "_text", number[F.col("_lang")].alias("_model")
    )
    count = trees.counted(lambda b: (b.column(0), b.column(1).to_numpy(zero_copy_only=False)), order)
    counts = sample.mapInArrow(count, "model int, gram long, n long").groupBy("model", "gram").agg(F.sum("n").alias("n"))
    keys, n = trees.collected(counts, len(langs))
    return langs, trees.fit(keys, n, order, interpolate=False) if len(keys) else None


def identify(
    df: DataFrame,
    langs: list[str],
    tree: trees.Tree | None,
    text: str = "text",
    predicted: str = "lang_pred",
    score: str = "score",
    unknown: str = "und",
) -> DataFrame:
    """The frame with the predicted language and its probability, all languages being equally likely before.

    A null text or one without a letter is `unknown` with score 0, and so is
    every text if there is no tree. Equal code lengths go to the smaller name.
    Columns of the result's names are replaced.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in (predicted, score)]
    schema = texts.extended(df.select(*kept).schema, **{predicted: "string", score: "double"})
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(*kept, letters.alias("_letters"), F.col(text).alias("_text"))
    model = spark.sparkContext.broadcast((langs, tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, frozen = model.value
        labels = np.array([*names, unknown], object)
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((n, max(1, len(names))))
            if frozen is not None:
                for block in texts.blocks(batch.column(len(kept) + 1), texts.BLOCK * 4 // max(4, len(names)), frozen.order):
                    block.data = texts.LOWER[block.data]
                    logs = frozen.log_probs(trees.grams(block, frozen.order))
                    logs[~trees.own(block)] = 0
                    np.add.at(total, block.rows, block.sums(logs))
            known = batch.column(len(kept)).to_numpy(zero_copy_only=False) & (frozen is not None)
            best = total.argmax(axis=1)
            share = 1 / np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -700)).sum(axis=1)
            columns = [batch.column(i) for i in range(len(kept))]
            columns.append(pa.array(labels[np.where(known, best, -1)], pa.string()))
            columns.append(pa.array(np.where(known, share, 0.0)))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, predicted, score])

    return rows.mapInArrow(run, schema)
