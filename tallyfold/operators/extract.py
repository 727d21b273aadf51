"""Splitting landing lines into records and footers.

`lines` is a frame (file, value): one row per text line, `file` naming the
extract the line belongs to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions import text as X
from tallyfold.operators.joins import lookup


def tagged(lines: DataFrame, keep_short: bool = False, kept: Sequence[str] = ()) -> DataFrame:
    """(file, rec_type, line) of every usable line, control lines included, and the columns to keep.

    A line needs two fields; `keep_short` keeps the others too, an empty line
    then has the empty type.
    """
    value = F.col("value")
    line = X.strip(value)
    if keep_short:
        return lines.select("file", *kept, X.record_type(line).alias("rec_type"), line.alias("line"))
    # With a separator in the line its end does not matter for the type, and filters
    # on the type then cost no full strip.
    return lines.where(F.contains(value, F.lit(X.FIELD))).select(
        "file", *kept, X.record_type(X.strip_left(value)).alias("rec_type"), line.alias("line")
    )


def is_control(rec_type: Column) -> Column:
    return rec_type.isin(X.HEADER, X.FOOTER)


def records(lines: DataFrame, keep_short: bool = False) -> DataFrame:
    """Data records: everything but header and footer."""
    return tagged(lines, keep_short).where(~is_control(F.col("rec_type")))


def of_type(recs: DataFrame, rec_type: str) -> DataFrame:
    return recs.where(F.col("rec_type") == rec_type)


def type_counts(recs: DataFrame) -> DataFrame:
    return recs.groupBy("rec_type").agg(F.count(F.lit(1)).alias("n"))


def type_list(recs: DataFrame) -> DataFrame:
    return recs.select("rec_type").distinct()


def footer_totals(lines: DataFrame) -> DataFrame:
    """(file, rec_type, declared): the last pair of a type counts.

    Malformed pairs have a null total; the file check fails their file.
    """
    pairs = (
        tagged(lines)
        .where(F.col("rec_type") == X.FOOTER)
        .select("file", F.inline(X.footer_pairs(F.col("line"))))
    )
    return pairs.groupBy("file", "rec_type").agg(F.max_by("declared", "position").alias("declared"))


def flagged_files(lines: DataFrame) -> DataFrame:
    """(file) of files that have a malformed footer pair, or footers that differ."""
    footers = tagged(lines).where(F.col("rec_type") == X.FOOTER)
    bad = F.exists(X.footer_pairs(F.col("line")), lambda p: p["bad"] == 1).cast("int")
    found = footers.select("file", F.xxhash64("line").alias("id"), bad.alias("bad")).groupBy("file")
    found = found.agg(F.max("bad").alias("bad"), F.min("id").alias("first"), F.max("id").alias("last"))
    return found.where((F.col("bad") == 1) | (F.col("first") != F.col("last"))).select("file")


def footers(lines: DataFrame) -> DataFrame:
    """(file, totals, flagged): all that the footers of a file say, from one scan of the text.

    totals holds the declared total of each type; flagged files have a malformed
    pair, or footers that differ.
    """
    found = tagged(lines).where(F.col("rec_type") == X.FOOTER)
    pairs = found.select("file", F.xxhash64("line").alias("id"), F.inline(X.footer_pairs(F.col("line"))))
    types = pairs.groupBy("file", "rec_type").agg(
        F.max_by("declared", "position").alias("declared"),
        F.max("bad").alias("bad"),
        F.min("id").alias("first"),
        F.max("id").alias("last"),
    )
    return types.groupBy("file").agg(
        F.map_from_entries(F.collect_list(F.struct("rec_type", "declared"))).alias("totals"),
        ((F.max("bad") == 1) | (F.min("first") != F.max("last"))).alias("flagged"),
    )


def with_footers(recs: DataFrame, found: DataFrame) -> DataFrame:
    """Attach the declared total; 0 where the footer does not name the type, null where the file is flagged."""
    joined = lookup(recs, found, ["file"], "footers")
    total = F.coalesce(F.try_element_at("totals", F.col("rec_type")), F.lit(0).cast("bigint"))
    sound = ~F.coalesce("flagged", F.lit(False))
    return joined.withColumn("declared", F.when(sound, total)).drop("totals", "flagged")


def with_declared(recs: DataFrame, totals: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Attach the declared total; 0 where the footer does not name the type.

    Files in `flagged` have no total that counts; theirs are null, and fail.
    """
    joined = lookup(recs, totals, ["file", "rec_type"], "declared")
    joined = joined.withColumn("declared", F.coalesce("declared", F.lit(0).cast("bigint")))
    if flagged is None:
        return joined
    joined = lookup(joined, flagged.withColumn("__flagged", F.lit(True)), ["file"], "flagged")
    return joined.withColumn("declared", F.when(F.col("__flagged").isNull(), F.col("declared"))).drop("__flagged")


def split_lines(recs: DataFrame) -> DataFrame:
    """Records as they appear in split files: the line and its declared total, empty if there is none that counts."""
    total = F.coalesce(F.col("declared").cast("string"), F.lit(""))
    return recs.withColumn("value", F.concat_ws(X.FIELD, "line", total))


def reference_row(split: DataFrame) -> DataFrame:
    """Per file, the total that the row of the highest record type ends with.

    Totals are first reduced per (file, type), which combines before the shuffle;
    the smallest one wins should a file's rows of that type disagree.
    """
    per_type = (
        split.select(
            "file", "rec_type", X.whole_number(X.text_after_last(F.col("value"))).alias("total")
        )
        .groupBy("file", "rec_type")
        .agg(F.min("total").alias("total"))
    )
    return per_type.groupBy("file").agg(
        F.max("rec_type").alias("rec_type"), F.max_by("total", "rec_type").alias("reference_count")
    )
