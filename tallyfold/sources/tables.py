"""Stored histories on plain parquet folders.

Append histories are partitioned by load date; an upsert rewrites only the load
dates it touches: it writes them aside as one commit and then moves them into
place, and whoever comes after a writer that was lost in between finishes the
moves or reads the rows where they lie. Slowly changing histories keep one folder
per commit: it holds all rows open after it and the rows it closed. Closed rows
are thus written once and never again, and a commit is one Spark write that
counts when its _SUCCESS marker is there.

Commits are numbered. Several writers may work at once: who finds the number
taken that follows on what was read starts again from there.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import ConfigError, HistoryConfig
from tallyfold.operators import history as H
from tallyfold.operators.joins import is_small, without_keys
from tallyfold.session import materialise, scratch
from tallyfold.sources import commits
from tallyfold.sources.commits import exists as _exists
from tallyfold.sources.commits import folder_of as _folder

VERSION = "history_version"
EXPIRED = "_EXPIRED"
#: Folder of a version that lists the closed rows of older ones that it replaces.
SUPERSEDED = "_superseded"


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything but markers: writing no rows leaves just those."""
    fs, folder = _folder(spark, path)
    return fs.exists(folder) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(folder))


# ---- append histories ----------------------------------------------------------


def read_dates(spark: SparkSession, path: str, dates: list[dt.date | None]) -> DataFrame | None:
    """Stored rows of some load dates, None if there are none."""
    names = ["__HIVE_DEFAULT_PARTITION__" if d is None else str(d) for d in dates]
    folders = [f"{path.rstrip('/')}/{H.LOADED}={n}" for n in names]
    present = [f for f in folders if _exists(spark, f)]
    if not present:
        return None
    rows = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*present)
    return rows.withColumn(H.LOADED, F.col(H.LOADED).cast("date"))


STAGED = "_staged"
REPLACED = "_replaced"


def _days(spark: SparkSession, path: str) -> list[str]:
    """Names of the load date folders in a folder."""
    return [n for n in commits.children(spark, path) if n.startswith(f"{H.LOADED}=")]


def _staged(spark: SparkSession, path: str) -> list[str]:
    """Commits that are written but not all moved into place, oldest first; torn ones do not count."""
    root = f"{path.rstrip('/')}/{STAGED}"
    found = [f"{root}/{name}" for name in commits.children(spark, root)]
    return [f for f in found if _days(spark, f) and _exists(spark, f"{f}/_SUCCESS")]


def _latest(spark: SparkSession, path: str) -> int:
    """Number of the last commit, 0 if there is none. Commits keep their folder when their rows have moved."""
    numbers = [n for n in commits.children(spark, f"{path.rstrip('/')}/{STAGED}") if n.isdigit()]
    return int(numbers[-1]) if numbers else 0


def _publish(spark: SparkSession, path: str) -> None:
    """Move the load dates of written commits into place.

    What a date held before is part of what replaces it, so losing the writer at
    any point loses no row: the rest is moved by the next one. Old rows go to a
    folder of the commit and date that is never empty again, so that of several
    writers at this none takes new rows for old ones.
    """
    for commit in _staged(spark, path):
        name = commit.rsplit("/", 1)[1]
        for day in _days(spark, commit):
            here, aside = f"{path.rstrip('/')}/{day}", f"{path.rstrip('/')}/{REPLACED}/{name}/{day}"
            if not _exists(spark, aside) and not (_exists(spark, here) and commits.claim(spark, here, aside)):
                commits.mark(spark, aside, "_REPLACED")
            commits.claim(spark, f"{commit}/{day}", here)
            commits.mark(spark, aside, "_REPLACED")
            for old in commits.children(spark, aside):
                if old != "_REPLACED":
                    commits.delete(spark, f"{aside}/{old}")


def read_append(spark: SparkSession, path: str, empty: T.StructType | None = None) -> DataFrame:
    """All stored rows, with every column that any batch had; null where a batch had none.

    Without stored rows the frame is empty and has the columns of `empty`, if given.
    """
    moving = {day: commit for commit in _staged(spark, path) for day in _days(spark, commit)}
    in_place = [f"{path.rstrip('/')}/{day}" for day in _days(spark, path) if day not in moving]
    parts = [(path, in_place)] if in_place and moving else [(path, [path])] if in_place else []
    for commit in dict.fromkeys(moving.values()):
        parts.append((commit, [f"{commit}/{day}" for day, of in moving.items() if of == commit]))
    if not parts:
        if empty is None:
            raise ConfigError(f"no rows stored in {path}")
        return spark.createDataFrame([], empty)
    reader = spark.read.option("mergeSchema", "true")
    frames = [reader.option("basePath", base).parquet(*folders) for base, folders in parts]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.withColumn(H.LOADED, F.col(H.LOADED).cast("date"))


def upsert_append(
    spark: SparkSession, path: str, batch: DataFrame, cfg: HistoryConfig, compare_stored: bool = False
) -> None:
    """Upsert a batch within the load dates it carries. A batch without rows changes nothing.

    Those dates, a handful of folder names, are fetched first. Folders of other
    dates are neither listed nor read.
    """
    order = [cfg.batch_date, *cfg.tie_breakers]
    batch = batch.withColumn(H.LOADED, F.col(H.LOADED).cast("date"))
    dates = [r[0] for r in batch.select(H.LOADED).distinct().collect()]
    if not dates:
        return
    for _ in range(commits.ATTEMPTS):
        base, aside = _latest(spark, path), commits.new_aside(path)
        try:
            _publish(spark, path)
            stored = read_dates(spark, path, dates)
            with scratch():
                rows = H.upsert(stored, batch, cfg.primary_keys, order, compare_stored=compare_stored)
                if len(dates) > 1:
                    # or every task would write a file for every date; large dates are split again
                    rows = rows.hint("rebalance", H.LOADED)
                rows.write.partitionBy(H.LOADED).parquet(aside)
        except (Py4JJavaError, PySparkException):
            if _latest(spark, path) == base:
                raise
            continue  # another writer replaced the files while they were read
        if commits.claim(spark, aside, f"{path.rstrip('/')}/{STAGED}/{base + 1:012d}"):
            return _publish(spark, path)
        commits.delete(spark, aside)
    raise commits.ConflictError(f"gave up on {path}")


# ---- slowly changing histories -------------------------------------------------


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{VERSION}=") and fs.exists(marker):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def _stored(spark: SparkSession, path: str, known: list[int]) -> DataFrame:
    """All committed folders under the newest one's schema, which has every column
    the older ones have; no file footers need merging."""
    parts = [f"{path.rstrip('/')}/{VERSION}={n}" for n in known]
    newest = spark.read.option("basePath", path).parquet(parts[-1])
    return spark.read.schema(newest.schema).option("basePath", path).parquet(*parts)


def read_history(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Whole history at a version (default: the latest), without its version column.

    Both conditions are on partition columns, so old open rows are never read. A
    version whose open rows have expired is an error, as its closed rows alone
    would be no history.
    """
    known = [n for n in versions(spark, path) if as_of is None or n <= as_of]
    if not known:
        raise ConfigError(f"no committed history in {path}")
    if _exists(spark, f"{path.rstrip('/')}/{VERSION}={known[-1]}/{EXPIRED}"):
        raise ConfigError(f"version {known[-1]} of {path} has expired")
    return _valid(spark, path, known).drop(VERSION)


def superseded(spark: SparkSession, path: str, known: list[int]) -> DataFrame | None:
    """(keys, start date, version) of closed rows that later versions replace, None if there are none."""
    folders = [f"{path.rstrip('/')}/{VERSION}={n}/{SUPERSEDED}" for n in known]
    folders = [f for f in folders if _exists(spark, f)]
    return spark.read.parquet(*folders) if folders else None


def _valid(spark: SparkSession, path: str, known: list[int]) -> DataFrame:
    """The rows valid at the last of some versions, with the version that holds them."""
    rows = _stored(spark, path, known)
    rows = rows.where((F.col(H.CURRENT) == 0) | (F.col(VERSION) == known[-1]))
    gone = superseded(spark, path, known)
    if gone is None:
        return rows
    # open rows are never listed, and only they can be many
    closed = without_keys(rows.where(F.col(H.CURRENT) == 0), gone, gone.columns, is_small(gone))
    return closed.unionByName(rows.where(F.col(H.CURRENT) == 1))


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Open rows of the latest version only."""
    return read_history(spark, path).where(F.col(H.CURRENT) == 1)


def _placed(
    spark: SparkSession, path: str, known: list[int], batch: DataFrame, cfg: HistoryConfig, run_date: dt.date | str | None, aside: str
) -> DataFrame:
    """Rows open after a batch that may be late, and rows it closes or changes; lists the closed rows that this replaces."""
    keys = list(cfg.primary_keys)
    mine, others = H.of_keys(_valid(spark, path, known), batch, cfg)
    mine = materialise(mine, "placed-before")
    after = materialise(H.placed(mine.drop(VERSION), batch, cfg, run_date), "placed-after")
    # a closed row stays where it is only if nothing of it changed
    closed = mine.where(F.col(H.CURRENT) == 0).select(*keys, H.START, VERSION)
    as_it_was = after.where(F.col("__kept") & (F.col(H.CURRENT) == 0)).select(*keys, H.START)
    gone = without_keys(closed, as_it_was, [*keys, H.START], is_small(as_it_was))
    if not gone.isEmpty():
        gone.write.parquet(f"{aside}/{SUPERSEDED}")
    open_rows = others.where(F.col(H.CURRENT) == 1).drop(VERSION)
    changed = after.where(~F.col("__kept") | (F.col(H.CURRENT) == 1)).drop("__kept", H.PREVIOUS)
    return open_rows.unionByName(changed, allowMissingColumns=True)


def commit_history(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    cfg: HistoryConfig,
    run_date: dt.date | str | None = None,
    out_of_order: bool = False,
    **how,
) -> int:
    """Merge a batch into the stored history as the next version.

    With `out_of_order` rows may be older than those stored (`history.placed`).
    Closed rows they change are written anew and listed as replaced; reading then
    leaves the old ones out.

    Folders are split by the current flag alone. Open rows have load dates of all
    ages, and a folder for each would mean a file per date and task; the rows a
    version closes share its run date anyway. A batch without rows is no commit;
    the version is then the latest one, -1 if there is none. Of several writers at
    once, each merges into what the one before it committed.
    """
    if batch.isEmpty():
        return next(iter(versions(spark, path)[-1:]), -1)
    for _ in range(commits.ATTEMPTS):
        known, aside = versions(spark, path), commits.new_aside(path)
        version = known[-1] + 1 if known else 0
        target = f"{path.rstrip('/')}/{VERSION}={version}"
        with scratch():
            if known and out_of_order:
                rows = _placed(spark, path, known, batch, cfg, run_date, aside)
            elif known:
                rows = H.changed_rows(read_open(spark, path), batch, cfg, run_date, **how)
            else:
                rows = H.merge(None, batch, cfg, run_date, out_of_order)
            rows.write.mode("append").partitionBy(H.CURRENT).parquet(aside)
        if _exists(spark, target) and not _exists(spark, f"{target}/_SUCCESS"):
            # what a writer left that wrote in place and was lost
            commits.claim(spark, target, commits.new_aside(path))
        if commits.claim(spark, aside, target):
            return version
        commits.delete(spark, aside)
    raise commits.ConflictError(f"gave up on {path}")


def expire_versions(spark: SparkSession, path: str, keep: int = 7) -> list[int]:
    """Drop the open rows of all but the newest `keep` versions; closed rows stay.

    A version is marked as expired before anything of it goes.
    """
    if keep < 1:
        raise ConfigError("at least one version must be kept")
    dropped = []
    for n in versions(spark, path)[:-keep]:
        fs, open_rows = _folder(spark, f"{path.rstrip('/')}/{VERSION}={n}/{H.CURRENT}=1")
        if fs.exists(open_rows):
            fs.create(spark._jvm.org.apache.hadoop.fs.Path(open_rows.getParent(), EXPIRED), True).close()
            fs.delete(open_rows, True)
            dropped.append(n)
    return dropped
