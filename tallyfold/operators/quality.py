"""Record-level checks: rules in, row outcomes and rule outcomes out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import Rule
from tallyfold.functions import predicates as P
from tallyfold.operators.columns import OUTCOME_COLUMNS
from tallyfold.operators.joins import lookup_stored, write_measured

PASSED, FAILED = "Passed", "Failed"
ROWS_PASS, ROWS_FAIL, ROWS_SKIP, RESULT = OUTCOME_COLUMNS


def is_row_rule(rule: Rule, columns: Sequence[str]) -> bool:
    """Rules on the whole frame or on an unknown column do not judge rows."""
    return rule.column is not None and rule.column in columns


def _value(df: DataFrame, column: str) -> Column:
    """A value as text, so that values of several columns fit into one; equal values give equal texts."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # there are two zeros
    return c.cast("string")


def repeated_values(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """(place, value): values that occur more than once in a column, nulls being one value; place numbers the columns.

    One aggregate for all columns. Counting combines before the shuffle, so a
    value held by a third of the rows is one partial count per task. Only the
    checked columns are read.
    """
    columns = [columns] if isinstance(columns, str) else columns
    cells = [F.struct(F.lit(i).alias("place"), _value(df, c).alias("value")) for i, c in enumerate(columns)]
    stacked = df.select(F.inline(F.array(*cells)))
    return stacked.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def with_unique_flags(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """Flag rows whose value occurs once, for several columns; `flags` names the flag of each.

    Repeated values are few when data is good, then no row moves; if they are
    many, hot ones are salted. They are counted once, for all columns together.
    """
    if not flags:
        return df
    repeated, small = write_measured(repeated_values(df, list(flags)), "repeated")
    for place, (column, flag) in enumerate(flags.items()):
        mine = repeated.where(F.col("place") == place).select(F.col("value").alias("__value"), F.lit(True).alias(flag))
        df = lookup_stored(df.withColumn("__value", _value(df, column)), mine, ["__value"], small=small).drop("__value")
        df = df.withColumn(flag, F.col(flag).isNull())
    return df


def _holds(df: DataFrame, rule: Rule) -> Column:
    c, held = F.col(f"`{rule.column}`"), df.schema[rule.column].dataType
    if rule.kind == "ColumnValues":
        return P.in_list(c, rule.want) if isinstance(rule.want, tuple) else P.equals(c, rule.want)
    if rule.kind == "ColumnLength":
        return P.has_length(c, rule.want)
    if rule.kind == "ColumnDataType":
        return P.of_type(c, rule.want, held)
    if rule.kind == "IsComplete":
        return P.complete(c)
    raise ValueError(f"unknown rule kind: {rule.kind}")


def row_outcomes(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Data columns plus the rules each row passes, fails and skips, and its result."""
    columns = df.columns
    unique = dict.fromkeys(r.column for r in rules if r.kind == "IsUnique" and r.column in columns)
    flags = {c: f"__unique{i}" for i, c in enumerate(unique)}
    checked = with_unique_flags(df, flags)
    row_rules = [r for r in rules if is_row_rule(r, columns)]
    skipped = [r.text for r in rules if not is_row_rule(r, columns)]
    # Each rule is judged once, in a column of its own. Rows that hold all rules take
    # ready-made lists; only the others have theirs put together.
    marks = [f"__holds{i}" for i in range(len(row_rules))]
    judged = checked.withColumns(
        {m: F.col(flags[r.column]) if r.kind == "IsUnique" else _holds(df, r) for m, r in zip(marks, row_rules)}
    )
    ok = reduce(lambda a, b: a & b, [F.col(m) for m in marks], F.lit(True))
    texts = lambda items: F.array(*[F.lit(t) for t in items]).cast("array<string>")
    kept = lambda test: F.array_compact(
        F.array(*[F.when(test(F.col(m)), r.text) for m, r in zip(marks, row_rules)]).cast("array<string>")
    )
    return judged.select(
        *[F.col(f"`{c}`") for c in columns],
        F.when(ok, texts(r.text for r in row_rules)).otherwise(kept(lambda h: h)).alias(ROWS_PASS),
        F.when(ok, texts([])).otherwise(kept(lambda h: ~h)).alias(ROWS_FAIL),
        texts(skipped).alias(ROWS_SKIP),
        F.when(ok, PASSED).otherwise(FAILED).alias(RESULT),
    )


def rule_outcomes(outcomes: DataFrame, rules: Sequence[Rule], rec_type: str, n_columns: int | None = None) -> DataFrame:
    """(rec_type, rule, outcome, reason, n_rows, n_failed), one row per rule.

    Works on row outcomes, best on stored ones: it then reads nothing but the
    column of failed rules. All rules share one aggregate.
    """
    columns = [c for c in outcomes.columns if c not in (ROWS_PASS, ROWS_FAIL, ROWS_SKIP, RESULT)]
    width = len(columns) if n_columns is None else n_columns
    row_rules = [r for r in rules if is_row_rule(r, columns)]
    totals = outcomes.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.array_contains(ROWS_FAIL, F.lit(r.text))).alias(f"failed{i}") for i, r in enumerate(row_rules)],
    )

    def verdict(rule: Rule) -> Column:
        if rule.kind == "ColumnCount":
            ok, bad = F.lit(width == rule.want), F.lit(0).cast("bigint")
            reason = F.lit(None if width == rule.want else f"frame has {width} columns").cast("string")
        elif rule not in row_rules:
            ok, bad, reason = F.lit(False), F.lit(0).cast("bigint"), F.lit("column not found")
        else:
            bad = F.col(f"failed{row_rules.index(rule)}")
            ok = bad == 0
            reason = F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" rows do not hold")))
        return F.struct(
            F.lit(rec_type).alias("rec_type"),
            F.lit(rule.text).alias("rule"),
            F.when(ok, PASSED).otherwise(FAILED).alias("outcome"),
            reason.alias("reason"),
            F.col("n_rows"),
            bad.alias("n_failed"),
        )

    if not rules:
        return totals.where(F.lit(False)).select(verdict(Rule("ColumnCount", None, width)).alias("v")).select("v.*")
    return totals.select(F.inline(F.array(*[verdict(r) for r in rules])))


def passed_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col(RESULT) == PASSED)


def failed_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col(RESULT) == FAILED)
