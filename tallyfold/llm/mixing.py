"""Mixing sources to target weights by entropy balancing.

A source's target is a share of all words; the rates of its documents are those
that change the documents least, in relative entropy over documents, among all
rates of `most` copies at most whose words meet the target. They are tilted
exponentially in the document's size x, rate = min(most, exp(lambda * x)), and
lambda is the minimum of a convex dual: Newton steps, kept inside a bracket,
run for all sources at once over the stored histogram of sizes.

Rates become copies, each rounded down or up, by carrying the error from
document to document within small groups of a source, long documents first; so
a group misses its words by a part of its shortest documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm import texts
from tallyfold.llm.inputs import sent
from tallyfold.session import discard, materialise

#: Documents of a source that are rounded together, about.
GROUP = 512


def size_of(text: Column) -> Column:
    """Runs of other than ASCII white space; 0 for null."""
    count = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return count.cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, n, source_size, target) from the rows (source, size), one for each source.

    Sources by code point, null last, weigh `weights` in turn and divide `share`
    of all words; a target stops at `most` times its source, and the others
    divide what is left over by weight. Sources are few next to documents: they
    are put in order in one task, aggregated.
    """
    each = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(number, F.lit(len(weights))).cast("int"))
    each = each.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    left = F.lit(share) * F.sum("source_size").over(everything) - (F.sum("cap").over(by_ratio) - F.col("cap"))
    each = each.withColumn("left", left)
    each = each.withColumn("weights", F.sum("weight").over(everything) - F.sum("weight").over(by_ratio) + F.col("weight"))
    full = F.col("cap") / F.col("weight") < F.col("left") / F.col("weights")
    each = each.withColumn("level", F.when(~full, F.col("left") / F.col("weights")))
    level = F.max(F.struct((F.col("level").isNotNull()).alias("some"), (-F.col("cap") / F.col("weight")).alias("r"), "level"))
    each = each.withColumn("common", level.over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("common")))
    return each.select("source", "n", "source_size", target.alias("target"))


def tilts(histogram: DataFrame, goals: DataFrame, most: int, tolerance: float = 1e-7, steps: int = 60) -> DataFrame:
    """(source, tilt) with the dual's minimum for each source of goals.

    histogram has (source, size, n). Sizes are measured in the source's mean
    size. A source whose target is `most` times its words has no minimum; its
    tilt is null, and its rates are `most`.
    """
    top = float(np.log(most))
    state = goals.where((F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most * (1 - 1e-12)))
    state = state.select(
        "source",
        "target",
        (F.col("source_size") / F.col("n")).alias("mean"),
        F.lit(0.0).alias("tilt"),
        F.lit(float("-inf")).alias("low"),
        F.lit(float("inf")).alias("high"),
    )
    state = stored = materialise(state, "mix-duals")
    histogram = histogram.where("size > 0").withColumnRenamed("source", "_source")
    for _ in range(steps):
        rows = histogram.join(state, histogram["_source"].eqNullSafe(state["source"]))
        x = F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size")
        inside = F.col("tilt") * x < top
        rate = F.exp(F.least(F.col("tilt") * x, F.lit(top)))
        sums = rows.groupBy(*state.columns).agg(
            F.sum(words * rate).alias("value"), F.sum(F.when(inside, words * x * rate).otherwise(0.0)).alias("slope")
        )
        gap = F.col("value") - F.col("target")
        sums = sums.select(
            "*",
            (F.abs(gap) / F.greatest("target", F.lit(1.0))).alias("off"),
            F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low")).alias("above"),
            F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high")).alias("below"),
            # a step is no longer than the tilt itself and one more
            (F.abs("tilt") + 1).alias("widest"),
            F.when(F.col("slope") > 0, -gap / F.col("slope")).otherwise(-F.signum(gap) * float("inf")).alias("newton"),
        )
        step = F.col("tilt") + F.greatest(-F.col("widest"), F.least(F.col("newton"), F.col("widest")))
        middle = (F.col("above") + F.col("below")) / 2
        # a step that leaves the bracket goes to its middle
        step = F.when((step > F.col("above")) & (step < F.col("below")), step).otherwise(middle)
        step = F.when(F.col("off") <= tolerance, F.col("tilt")).otherwise(step)
        kept = sums.select(
            "source", "target", "mean", step.alias("tilt"), F.col("above").alias("low"), F.col("below").alias("high"), "off"
        )
        kept = materialise(kept, "mix-duals")
        discard(stored)
        state, stored = kept.drop("off"), kept
        if kept.where(F.col("off") > tolerance).isEmpty():
            break
    return state.select("source", "tilt")


def _copies(pdf: pd.DataFrame) -> np.ndarray:
    """Whole copies of the documents of a group; the error goes from long documents on to short ones."""
    size, rate = pdf["size"].to_numpy(np.float64), pdf["rate"].to_numpy(np.float64)
    order = np.lexsort((pdf["spot"].to_numpy(), -size))
    out, error = np.zeros(len(pdf), np.int64), 0.0
    for i in order:
        if not size[i]:
            out[i] = 1
            continue
        low, high = np.floor(rate[i]), np.ceil(rate[i])
        out[i] = min(high, max(low, np.floor(rate[i] + error / size[i] + 0.5)))
        error += (rate[i] - out[i]) * size[i]
    return out


def mix(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """The frame without its text, with size, source_size, target, rate, copies and taken (words of the copies).

    Null texts have no words; a document without words is kept once. Null is a
    source of its own. Equal rows are told apart by nothing but chance of order,
    which leaves the result's rows the same. Columns of the result's names are
    replaced. Reruns over the same rows agree.
    """
    added = ("size", "source_size", "target", "rate", "copies", "taken")
    kept = [c for c in df.columns if c not in (*added, text)]
    keys = [f"k{i}" for i in range(len(kept))]
    named = [F.col(c).alias(k) for c, k in zip(kept, keys, strict=True)]
    rows = df.select(*named, F.col(source).alias("source"), size_of(F.col(text)).alias("size"), F.xxhash64(text, *kept).alias("spot"))
    rows = materialise(rows, "mix-sizes")
    goals = materialise(targets(rows, weights, share, most), "mix-targets")
    histogram = materialise(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    tilt = tilts(histogram, goals, most).withColumnRenamed("source", "_tilted")
    goals = goals.join(tilt, goals["source"].eqNullSafe(tilt["_tilted"]), "left").drop("_tilted")
    goals = goals.withColumnRenamed("source", "_source")
    rows = rows.join(goals, rows["source"].eqNullSafe(goals["_source"])).drop("_source")
    x = F.col("size") / (F.col("source_size") / F.col("n"))
    rate = F.when(F.col("tilt").isNull(), F.lit(float(most))).otherwise(
        F.exp(F.least(F.col("tilt") * x, F.lit(float(np.log(most)))))
    )
    groups = F.ceil(F.col("n") / GROUP).cast("long")
    rows = rows.select(
        *keys,
        "source",
        "size",
        "source_size",
        "target",
        "spot",
        F.when(F.col("size") > 0, rate).otherwise(1.0).alias("rate"),
        F.pmod("spot", groups).alias("group"),
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(copies=_copies(pdf)).drop(columns=["source", "spot", "group"])

    out = texts.extended(rows.drop("source", "spot", "group").schema, copies="long")
    rounded = rows.groupBy("source", "group").applyInPandas(run, out)
    return rounded.select(
        *[F.col(k).alias(c) for k, c in zip(keys, kept, strict=True)],
        "size",
        "source_size",
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(df: DataFrame, text: str = "text", source: str = "source", copy: str = "copy", **settings: object) -> DataFrame:
    """The frame's rows, each as often as the mix takes it, numbered from 1 in the column `copy`."""
    place = "_place"
    while place in df.columns:
        place = "_" + place
    placed = materialise(df.withColumn(place, F.monotonically_increasing_id()), "mix-input")
    plan = mix(placed.select(place, F.col(source).alias("source"), F.col(text).alias("text")), **settings)
    plan = plan.where("copies > 0").select(place, F.col("copies").cast("int").alias("_copies"))
    rows = placed.join(sent(materialise(plan, "mix-plan")), place).drop(place)
    kept = [c for c in df.columns if c != copy]
    return rows.select(*kept, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias(copy))
