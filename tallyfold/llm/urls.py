"""URL filter: domain rules first, then a ratio of two character language models.

Host and path rules decide the URLs they fit. Those URLs are also the training
data: a smoothed variable-order Markov model of bytes (Witten and Bell's
escapes, interpolated) for the allowed ones and one for the blocked ones. Any
other URL is judged by its log-likelihood under both, the difference divided by
its length in bytes, against a threshold calibrated on rule-judged URLs that the
models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts, trees


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the URL's path starts with the rule's path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased; '' without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; '' without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = inside & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


@dataclass
class Ratio:
    """Two frozen models (column 0 blocked, column 1 allowed) and the threshold on their difference."""

    tree: trees.Tree
    threshold: float


def differences(tree: trees.Tree, column: pa.Array) -> np.ndarray:
    """Allowed minus blocked log-likelihood per byte; 0 for an empty URL."""
    total = np.zeros(len(column))
    for block in texts.blocks(column, lead=tree.order):
        logs = tree.log_probs(trees.grams(block, tree.order))
        logs[~trees.own(block)] = 0
        np.add.at(total, block.rows, block.sums(logs[:, 1].astype(np.float64) - logs[:, 0]))
    _, offsets = texts.utf8(column)
    return total / np.maximum(np.diff(offsets), 1)


def scored(df: DataFrame, tree: trees.Tree, text: str, score: str) -> DataFrame:
    """The frame with the length-normalised difference of the text; null counts as empty."""
    kept = [c for c in df.columns if c != score]
    rows = df.select(*kept, F.col(text).alias("_scored_text"))
    sent = df.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept))]
            columns.append(pa.array(differences(sent.value, batch.column(len(kept)))))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, score])

    return rows.mapInArrow(run, texts.extended(df.select(*kept).schema, **{score: "double"}))


def train(
    df: DataFrame, text: str, verdict: str, key: str, per_verdict: int = 20_000, order: int = 4, held: int = 5
) -> Ratio | None:
    """Models from about `per_verdict` URLs of each verdict, picked by the hash of their key; fewer give all.

    One in `held` of the picked ones is not learned from. All URLs with a verdict
    that the models have not seen calibrate the threshold: their differences are
    put in bins of a thousandth, and the threshold is the cut half way between two
    bins at which the mean of the two error rates is least, the one nearest to 0 if
    several are. Without URLs of either verdict there is no ratio.
    """
    steps = 1 << 24
    rows = df.where(F.col(verdict).isin("allow", "block") & F.col(text).isNotNull())
    sizes = {r[verdict]: r["count"] for r in rows.groupBy(verdict).count().collect()}
    if len(sizes) < 2:
        return None
    share = {k: int(min(1, per_verdict / n) * steps) for k, n in sizes.items()}
    spot = F.pmod(F.xxhash64(key), F.lit(steps))
    allowed = F.col(verdict) == "allow"
    picked = spot < F.when(allowed, share["allow"]).otherwise(share["block"])
    seen = F.coalesce(picked & (spot % held != 0), F.lit(False))
    rows = rows.select(F.col(text).alias("text"), allowed.cast("int").alias("model"), seen.alias("seen"))
    count = trees.counted(lambda b: (b.column(0), b.column(1).to_numpy(zero_copy_only=False)), order, fold=False)
    counts = rows.where("seen").select("text", "model").mapInArrow(count, "model int, gram long, n long")
    keys, n = trees.collected(counts.groupBy("model", "gram").agg(F.sum("n").alias("n")), 2)
    if not len(keys) or not n.sum(axis=0).all():
        return None
    tree = trees.fit(keys, n, order, interpolate=True)
    bins = scored(rows.where("NOT seen"), tree, "text", "score")
    bins = bins.groupBy(F.floor(F.col("score") * 1000).cast("int").alias("bin"), "model").count().toPandas()
    if bins["model"].nunique() < 2:
        return Ratio(tree, 0.0)
    table = bins.pivot_table(index="bin", columns="model", values="count", fill_value=0, aggfunc="sum").sort_index()
    table = table / table.sum()
    # a cut below a bin, half way to the bin before, blocks everything under it
    below = table.cumsum().shift(1, fill_value=0.0)
    errors = (below[1] + 1 - below[0]).round(12).to_numpy()
    bins = table.index.to_numpy()
    cuts = np.append(bins[0], (bins[:-1] + 1 + bins[1:]) / 2)[errors == errors.min()]
    return Ratio(tree, float(min(cuts, key=lambda cut: (abs(cut), cut))) / 1000)


def judge(
    df: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id", default: str = "allow", **training: int
) -> DataFrame:
    """The frame with host, path, rule, verdict and the score of the URL.

    Null URLs and those without :// have no host and path, fit no rule and are
    judged by the models like any other (a null one as an empty text). Without
    training URLs of both verdicts the rest gets the default. Columns of the
    result's names are replaced.
    """
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "score")]
    rows = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"))
    ratio = train(rows, url, "verdict", key, **training)
    if ratio is None:
        return rows.withColumn("verdict", F.coalesce("verdict", F.lit(default))).withColumn("score", F.lit(0.0))
    out = scored(rows, ratio.tree, url, "score")
    guess = F.when(F.col("score") >= ratio.threshold, "allow").otherwise("block")
    return out.withColumn("verdict", F.coalesce("verdict", guess))
