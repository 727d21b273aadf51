"""Histories: keyed upsert, and slowly changing rows with validity dates.

Every function takes and returns frames; run dates are arguments. Writing lives
in tallyfold.sources.tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import ConfigError, HistoryConfig
from tallyfold.functions import text as X
from tallyfold.operators.columns import align, clean_names, drop_outcomes
from tallyfold.operators.joins import (
    lookup,
    lookup_stored,
    null_safe,
    renamed,
    salted_left_join,
    without_keys,
    write_measured,
)

# The open end date, the mark of a deleted row, the history columns.
OPEN_END = dt.date(9999, 12, 31)
DELETE_MARK = "D"
START, END, CURRENT, DELETED, LOADED = (
    "record_start_date",
    "record_end_date",
    "current_record_flag",
    "delete_flag",
    "dt",
)

Day = dt.date | str


def day(value: Day | None) -> Column:
    return F.current_date() if value is None else F.lit(str(value)).cast("date")


# ---- append-upsert -----------------------------------------------------------


def history_rows(batch: DataFrame, run_date: Day | None = None, stamp: bool = True) -> DataFrame:
    """Checked rows made ready for a history: outcome columns off, names cleaned,
    load date on. With `stamp=False` the batch must bring its own load date."""
    rows = clean_names(drop_outcomes(batch))
    if stamp:
        return rows.withColumn(LOADED, day(run_date))
    if LOADED not in rows.columns:
        raise ConfigError(f"batch has no {LOADED} column")
    return rows


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest order columns (nulls lowest).

    Rank-one filtering is applied by Spark in every task before the shuffle, so a
    hot key sends at most one row per task.
    """
    by = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("__rank", F.row_number().over(by)).where(F.col("__rank") == 1).drop("__rank")


def upsert(
    stored: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scope: str = "partition",
    compare_stored: bool = False,
) -> DataFrame:
    """Stored rows with the batch laid over them, one row per key.

    scope "partition" keeps one row per key and load date, "table" one per key.
    The incoming row wins whatever it holds; `compare_stored` lets the greater
    order columns win across both sides. `stored` must hold each key once, as this
    function leaves it.
    """
    if scope not in ("partition", "table"):
        raise ConfigError(f"unknown upsert scope: {scope}")
    identity = ([LOADED] if scope == "partition" else []) + [k for k in keys if k != LOADED]
    if stored is None:
        return newest(batch, identity, order)
    if compare_stored:
        both = stored.withColumn("__incoming", F.lit(0)).unionByName(
            batch.withColumn("__incoming", F.lit(1)), allowMissingColumns=True
        )
        return newest(both, identity, [*order, "__incoming"]).drop("__incoming")
    incoming, small = write_measured(newest(batch, identity, order), "incoming", identity)
    return without_keys(stored, incoming, identity, small).unionByName(incoming, allowMissingColumns=True)


# ---- slowly changing rows ------------------------------------------------------


def delete_flag(df: DataFrame, indicator: str | None) -> Column:
    if not indicator:
        return F.lit(0)
    return F.when(F.col(indicator) == DELETE_MARK, 1).otherwise(0)


def new_rows(batch: DataFrame, cfg: HistoryConfig, run_date: Day | None = None) -> DataFrame:
    """Batch rows as open history rows."""
    held = batch.select(cfg.batch_date).schema[0].dataType
    given = F.col(cfg.batch_date)
    start = given.cast("date") if isinstance(held, T.DatetimeType) else X.batch_day(given)
    return batch.withColumns(
        {
            START: start,
            END: F.lit(OPEN_END),
            CURRENT: F.lit(1),
            DELETED: delete_flag(batch, cfg.delete_indicator),
            LOADED: day(run_date),
        }
    )


def current_rows(history: DataFrame) -> DataFrame:
    """Open rows that are not deletions."""
    return history.where((F.col(CURRENT) == 1) & (F.col(DELETED) == 0))


def end_date(run_date: Day | None, close_on: str) -> Column:
    ends = {
        "run_date": day(run_date),
        "day_before": F.date_sub(day(run_date), 1),
        "open": F.lit(OPEN_END),
    }
    if close_on not in ends:
        raise ConfigError(f"unknown close_on: {close_on}")
    return ends[close_on]


def closing_columns(run_date: Day | None, close_on: str) -> dict[str, Column]:
    return {END: end_date(run_date, close_on), CURRENT: F.lit(0), LOADED: day(run_date)}


def _each_key_once(cfg: HistoryConfig) -> bool:
    """Open rows hold a primary key once, so a join key that covers it is never hot."""
    return set(cfg.primary_keys) <= set(cfg.join_on)


def close_rows(
    current: DataFrame, batch: DataFrame, cfg: HistoryConfig, run_date: Day | None = None, close_on: str = "run_date"
) -> DataFrame:
    """Current rows that the batch replaces, closed. Each comes out once, however
    often the batch repeats its key."""
    keys = list(cfg.join_on)
    replaced, small = write_measured(batch.select(*keys).distinct(), "replaced")
    if small or _each_key_once(cfg):
        right, pairs = renamed(replaced, keys)
        hit = current.join(F.broadcast(right) if small else right, null_safe(current, right, pairs), "left_semi")
    else:
        hit = salted_left_join(current, replaced.withColumn("__hit", F.lit(True)), keys)
        hit = hit.where(F.col("__hit")).drop("__hit")
    return hit.withColumns(closing_columns(run_date, close_on))


def _additions(batch: DataFrame, cfg: HistoryConfig, run_date: Day | None) -> DataFrame:
    """The newest row of each key in a batch, as an open row."""
    return newest(new_rows(batch, cfg, run_date), cfg.primary_keys, [START, cfg.batch_date, *cfg.tie_breakers])


def changed_rows(
    open_rows: DataFrame,
    batch: DataFrame,
    cfg: HistoryConfig,
    run_date: Day | None = None,
    close_on: str = "run_date",
    strict_reference: bool = False,
    closing: bool = True,
) -> DataFrame:
    """What a batch makes of the open rows: rows left open, rows closed, rows added.

    A row is identified by its key and start date, so applying a batch twice
    changes nothing: its own rows are replaced, not closed. `strict_reference`
    leaves deletions open when their key returns. `closing=False` only adds.
    The rows to add are written once, as they are both a result and what open rows
    are looked up in.
    """
    keys, on = list(cfg.primary_keys), list(cfg.join_on)
    added, small = write_measured(_additions(batch, cfg, run_date), "additions", [*keys, START])
    once = _each_key_once(cfg)
    if closing and set(on) == set(keys):
        # both sides hold a key once, so one lookup answers both questions
        marks = added.select(*keys, F.col(START).alias("__start"), F.lit(True).alias("__hit"))
        rows = lookup_stored(open_rows, marks, keys, once, small)
        replaced = F.col("__hit") & F.col("__start").eqNullSafe(F.col(START))
    else:
        again = added.select(*keys, START, F.lit(True).alias("__again"))
        rows = lookup_stored(open_rows, again, [*keys, START], True, small)
        replaced = F.col("__again")
        if closing:
            rows = lookup(rows, added.select(*on).distinct().withColumn("__hit", F.lit(True)), on, "closing")
    rows = rows.where(~F.coalesce(replaced, F.lit(False)))
    if closing:
        hit = F.coalesce("__hit", F.lit(False))
        if strict_reference:
            hit = hit & (F.col(DELETED) == 0)
        rows = rows.withColumns(
            {c: F.when(hit, new).otherwise(F.col(c)) for c, new in closing_columns(run_date, close_on).items()}
        )
    kept = rows.select(*open_rows.columns)
    return kept.unionByName(added, allowMissingColumns=True)


PREVIOUS = "__previous"


def placed(stored: DataFrame | None, batch: DataFrame, cfg: HistoryConfig, run_date: Day | None = None) -> DataFrame:
    """Rows of a key and the batch's, each valid until the next one's start, whatever came first.

    `stored` are all rows, open and closed, of the keys in the batch. A key and
    start date is one row, the one with the greatest batch date and tie breakers,
    of equal ones the incoming; so rows that are told apart by these come out the
    same in any order of batches, but for the load date, which is that of the last
    change. `__previous` holds the end date that a stored row had, `__kept`
    whether it is as it was.
    """
    keys = list(cfg.primary_keys)
    incoming = new_rows(batch, cfg, run_date).withColumn("__incoming", F.lit(1))
    if stored is not None:
        was = stored.withColumn("__incoming", F.lit(0)).withColumn(PREVIOUS, F.col(END))
        incoming = was.unionByName(incoming, allowMissingColumns=True)
    else:
        incoming = incoming.withColumn(PREVIOUS, F.lit(None).cast("date"))
    once = newest(incoming, [*keys, START], [cfg.batch_date, *cfg.tie_breakers, "__incoming"])
    along = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(START))
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(START))) == 1
    rows = once.withColumns({"__end": F.lead(START).over(along), "__last": last})
    end = F.when(F.col("__last"), F.lit(OPEN_END)).otherwise(F.col("__end"))
    current = F.col("__last").cast("int")
    kept = (F.col("__incoming") == 0) & F.col(END).eqNullSafe(end) & (F.col(CURRENT) == current)
    rows = rows.withColumns({"__kept": kept, END: end, CURRENT: current, LOADED: F.when(kept, F.col(LOADED)).otherwise(day(run_date))})
    return rows.drop("__end", "__last", "__incoming")


def of_keys(history: DataFrame, batch: DataFrame, cfg: HistoryConfig) -> tuple[DataFrame, DataFrame]:
    """The rows of a history whose key is in a batch, and the others."""
    keys = list(cfg.primary_keys)
    marked = lookup(history, batch.select(*keys).distinct().withColumn("__hit", F.lit(True)), keys, "keys")
    hit = F.coalesce("__hit", F.lit(False))
    return marked.where(hit).drop("__hit"), marked.where(~hit).drop("__hit")


def merge(
    history: DataFrame | None,
    batch: DataFrame,
    cfg: HistoryConfig,
    run_date: Day | None = None,
    out_of_order: bool = False,
    **how,
) -> DataFrame:
    """Whole history after a batch. Closed rows pass through unshuffled.

    With `out_of_order` every row of the batch gets its place among its key's rows
    by its start date, see `placed`; without, the newest one of each key closes
    what is open.
    """
    if out_of_order:
        if how:
            raise ConfigError(f"not with out_of_order: {', '.join(how)}")
        if history is None:
            return placed(None, batch, cfg, run_date).drop(PREVIOUS, "__kept")
        mine, others = of_keys(history, batch, cfg)
        return others.unionByName(placed(mine, batch, cfg, run_date).drop(PREVIOUS, "__kept"), allowMissingColumns=True)
    if history is None:
        return _additions(batch, cfg, run_date)
    closed = history.where(F.col(CURRENT) == 0)
    changed = changed_rows(history.where(F.col(CURRENT) == 1), batch, cfg, run_date, **how)
    return closed.unionByName(changed, allowMissingColumns=True)


def load_without_closing(
    history: DataFrame | None, batch: DataFrame, cfg: HistoryConfig, run_date: Day | None = None
) -> DataFrame:
    """Open rows stay as they are and the batch is added."""
    return merge(history, batch, cfg, run_date, closing=False)


def aligned(history: DataFrame, like: DataFrame) -> DataFrame:
    return align(history, like, add_missing=True)
