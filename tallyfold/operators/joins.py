"""Key lookups that neither broadcast unchecked data nor pile up on hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.session import materialise

# A lookup table is broadcast only when it was counted and is at most this long
# and its rows are estimated at no more than this many bytes in all.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Keys with more than 1/HOT_SHARE of all rows get salted; there are at most
# HOT_SHARE of them, whatever the data size.
HOT_SHARE = 2048
SKETCH_ITEMS = 8 * HOT_SHARE
SKETCH_GROUPS = 256


def key_hash(keys: Sequence[str], types: Sequence[T.DataType] = ()) -> Column:
    """Hash of a key; `types` are what the other side of a join holds it as."""
    cols = [F.col(f"`{k}`") for k in keys]
    return F.xxhash64(*[c.cast(t) for c, t in zip(cols, types)] if types else cols)


def hot_keys(rows: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """(__hash, __fan) of the keys that hold more than about 1/share of the rows.

    Frequent-item sketches are built in every task and merged in groups of tasks,
    so no row is shuffled and no reducer merges more than its group's sketches;
    the groups' top items are then added up. The sums are written down, because a
    sketch may come out differently when computed again. `__fan` is the number of
    salts for the key's rows, in proportion to their share.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = (
        rows.select(key_hash(keys).alias("h"), F.spark_partition_id().alias("p"))
        .groupBy(F.pmod("p", F.lit(SKETCH_GROUPS)).alias("g"))
        .agg(F.expr(f"approx_top_k(h, {2 * share}, {SKETCH_ITEMS})").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    everything = F.struct(F.lit(None).cast("bigint").alias("item"), F.col("n").alias("count"))
    counts = materialise(
        groups.select(F.inline(F.concat("top", F.array(everything)))).groupBy("item").agg(F.sum("count").alias("n")),
        "hot",
    )
    total = counts.where(F.col("item").isNull()).head()
    n = total.n if total else 0
    # more salts than reducers, as hashing does not place them evenly
    fan = F.greatest(F.lit(2), F.ceil(F.col("n") * F.lit(8 * width) / F.lit(max(n, 1)))).cast("int")
    return (
        counts.where(F.col("item").isNotNull() & (F.col("n") * share > n))
        .orderBy(F.desc("n"), "item")
        .limit(share)
        .select(F.col("item").alias("__hash"), fan.alias("__fan"))
    )


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality on every pair of columns."""
    condition = F.lit(True)
    for l, r in pairs:
        condition = condition & left[l].eqNullSafe(right[r])
    return condition


def renamed(table: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    names = {k: f"__key{i}" for i, k in enumerate(keys)}
    return table.withColumnsRenamed(names), list(names.items())


def salted_left_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], share: int = HOT_SHARE
) -> DataFrame:
    """Left join to a one-row-per-key table with the rows of hot keys spread out.

    Rows of a hot key are dealt over `__fan` salts by the partition they come
    from, which a retried task repeats exactly. The table holds the key once per
    salt; as hot keys are few and fans add up to a small multiple of the number of
    reducers, the copies are few as well.
    """
    hot = F.broadcast(hot_keys(rows, keys, share))  # at most `share` rows
    right, pairs = renamed(table, keys)
    dealt = (
        rows.withColumn("__h", key_hash(keys))
        .join(hot, F.col("__h") == hot["__hash"], "left")
        .withColumn("__salt", F.when(hot["__fan"].isNotNull(), F.pmod(F.spark_partition_id(), hot["__fan"])).otherwise(0))
        .drop("__h", "__hash", "__fan")
    )
    copies = (
        right.withColumn("__h", key_hash([r for _, r in pairs], [rows.schema[l].dataType for l, _ in pairs]))
        .join(hot, F.col("__h") == hot["__hash"], "left")
        .withColumn("__slot", F.explode(F.sequence(F.lit(0), F.coalesce(hot["__fan"], F.lit(1)) - 1)))
        .drop("__h", "__hash", "__fan")
    )
    joined = dealt.join(copies, null_safe(dealt, copies, pairs + [("__salt", "__slot")]), "left")
    return joined.drop("__salt", "__slot", *[r for _, r in pairs])


def _size(table: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Aggregates for the length of a table and its estimated bytes in memory."""
    chosen = [f for f in table.schema.fields if columns is None or f.name in columns]
    row = F.lit(16 * len(chosen))
    for f in chosen:
        if isinstance(f.dataType, T.StringType):
            row = row + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        if isinstance(f.dataType, (T.MapType, T.ArrayType)):
            row = row + 48 * F.coalesce(F.size(F.col(f"`{f.name}`")), F.lit(0))
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("b")]


def _within_bounds(n: int, b: int) -> bool:
    return n <= BROADCAST_ROWS and b <= BROADCAST_BYTES


def is_small(table: DataFrame) -> bool:
    """Whether a stored table is proven short and narrow enough to broadcast."""
    return _within_bounds(*table.agg(*_size(table)).head())


def lookup_stored(
    rows: DataFrame, stored: DataFrame, keys: Sequence[str], once: bool = False, small: bool | None = None
) -> DataFrame:
    """Left join wide rows to a one-row-per-key table that lies in files.

    Proven small: broadcast, so the rows are not shuffled at all. Otherwise a
    shuffled join, with hot keys salted unless the rows hold each key `once`.
    `small` is for tables that were measured when written.
    """
    small = is_small(stored) if small is None else small
    if not small and not once:
        return salted_left_join(rows, stored, keys)
    right, pairs = renamed(stored, keys)
    side = F.broadcast(right) if small else right
    return rows.join(side, null_safe(rows, right, pairs), "left").drop(*[r for _, r in pairs])


def write_measured(table: DataFrame, name: str, columns: Sequence[str] | None = None) -> tuple[DataFrame, bool]:
    """Write a table once, measuring it on the way; returns it and whether it, or
    the given columns of it, are small enough to broadcast.

    A retried task can only make the table look larger than it is.
    """
    size = Observation()
    stored = materialise(table.observe(size, *_size(table, columns)), name)
    return stored, _within_bounds(size.get["n"], size.get["b"])


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], name: str = "lookup") -> DataFrame:
    """The same for a table still to be computed."""
    stored, small = write_measured(table, name)
    return lookup_stored(rows, stored, keys, small=small)


def without_keys(rows: DataFrame, keys_table: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """Rows whose key is not in the table (null keys match null keys).

    For stored tables that hold each key once, so no key can be hot. A table
    measured as `small` is broadcast.
    """
    right, pairs = renamed(keys_table.select(*keys), keys)
    return rows.join(F.broadcast(right) if small else right, null_safe(rows, right, pairs), "left_anti")
