"""Tables that the queries of this subpackage read, and sides of joins that are small enough to send."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers each that a join may broadcast.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sent(stored: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, as a side of a join: broadcast if its rows are few, else shuffled."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored
