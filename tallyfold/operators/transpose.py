"""Long records to one wide row per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.config import TransposeConfig
from tallyfold.operators.columns import pick


def transpose(df: DataFrame, cfg: TransposeConfig) -> DataFrame:
    """Pivot one column into columns, taking one value per cell.

    With `pivot_values` no discovery job runs and other values are dropped;
    without them a distinct job finds the values, a null one included. With
    `order_by` the earliest value of a cell is taken; without it any one is, so
    cells should be unique. Spark aggregates per (group, pivot value) first, with
    partial results before the shuffle, which keeps hot groups small.
    """
    needed = list(dict.fromkeys((*cfg.group_by, cfg.pivot, cfg.value, *cfg.order_by)))
    rows = pick(pick(df, cfg.select or df.columns), needed)
    grouped = rows.groupBy(*cfg.group_by)
    wide = grouped.pivot(cfg.pivot, list(cfg.pivot_values)) if cfg.pivot_values else grouped.pivot(cfg.pivot)
    if cfg.order_by:
        return wide.agg(F.min_by(cfg.value, F.struct(*cfg.order_by)))
    return wide.agg(F.first(cfg.value))
