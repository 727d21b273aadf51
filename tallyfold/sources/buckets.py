"""Validity-dated histories in hash buckets of their keys.

A commit reads and writes only the buckets of the keys it carries. Its folder
holds the open rows of those buckets and the rows it closed, as files that Spark
knows to be bucketed; a list names, for every bucket, the commit that holds its
open rows now. Open rows are joined as a bucketed table put together from these
folders, so that only the batch is shuffled.

Folders are written aside and claimed by number. When another writer was faster
and touched other buckets, its list is taken over and the work stands; when it
touched the same, the work is done again.

The key must be complete, and the closing key is the primary key: open rows then
hold each key once.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import ConfigError, HistoryConfig
from tallyfold.operators import history as H
from tallyfold.session import discard, materialise
from tallyfold.sources import commits

COMMIT = "commit"
BUCKET = "history_bucket"
MANIFEST = "_manifest.json"
N_BUCKETS = 256


def _folder(path: str, n: int) -> str:
    return f"{path.rstrip('/')}/{COMMIT}={n}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first. A folder gets its name when it is whole."""
    names = commits.children(spark, path)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{COMMIT}="))


def manifest(spark: SparkSession, path: str, n: int) -> dict:
    """What a version consists of: keys, number of buckets, schema, and the commit of each bucket's open rows."""
    return json.loads(commits.read_text(spark, f"{_folder(path, n)}/{MANIFEST}"))


def bucket_of(keys: list[str], n: int) -> Column:
    """The bucket Spark puts a key in."""
    return F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(n))


def _schema(about: dict) -> T.StructType:
    return T.StructType.fromJson(about["schema"])


def _latest(spark: SparkSession, path: str, as_of: int | None = None) -> tuple[int, dict] | None:
    known = [n for n in versions(spark, path) if as_of is None or n <= as_of]
    return (known[-1], manifest(spark, path, known[-1])) if known else None


def _held(about: dict) -> dict[int, int]:
    """The commit of each bucket that has open rows."""
    return {b: n for b, n in enumerate(about["open"]) if n >= 0}


def open_table(spark: SparkSession, path: str, about: dict, touched: list[int] | None = None) -> tuple[DataFrame, str]:
    """Open rows, of some buckets only if given, as a bucketed table of the catalog; returns its name too.

    The name is of this session's making and holds no data: drop it when done.
    """
    name, keys = f"history_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in about["keys"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(about).fields if f.name != H.CURRENT)
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}, `{BUCKET}` INT) USING parquet PARTITIONED BY (`{BUCKET}`) "
        f"CLUSTERED BY ({keys}) INTO {about['n']} BUCKETS LOCATION '{path.rstrip('/')}/_none'"
    )
    held = {b: n for b, n in _held(about).items() if touched is None or b in touched}
    places = [f"PARTITION (`{BUCKET}` = {b}) LOCATION '{_folder(path, n)}/{H.CURRENT}=1/{BUCKET}={b}'" for b, n in held.items()]
    if places:
        spark.sql(f"ALTER TABLE `{name}` ADD {' '.join(places)}")
    return spark.table(name).drop(BUCKET).withColumn(H.CURRENT, F.lit(1)), name


def _changes(open_rows: DataFrame, added: DataFrame, keys: list[str], run_date: dt.date | str | None, close_on: str) -> DataFrame:
    """Rows left open, closed and added, from one join in which only the additions move."""
    columns = added.columns
    old = open_rows.select(*[F.col(f"`{c}`") if c in open_rows.columns else F.lit(None).cast(added.schema[c].dataType).alias(c) for c in columns])
    old = old.select(*[F.col(f"`{k}`") for k in keys], F.struct(*columns).alias("__old"))
    new = added.select(*[F.col(f"`{k}`").alias(f"__{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("__new"))
    same = [F.col(f"`{k}`") == F.col(f"__{i}") for i, k in enumerate(keys)]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    both = old.join(new, condition, "full")
    o, n = F.col("__old"), F.col("__new")
    closing = H.closing_columns(run_date, close_on)
    closed = F.struct(*[closing.get(c, o[c]).alias(c) for c in columns])
    replaced = n.isNotNull() & n[H.START].eqNullSafe(o[H.START])
    after = F.when(o.isNotNull() & ~replaced, F.when(n.isNull(), o).otherwise(closed))
    rows = F.filter(F.array(after, n), lambda r: r.isNotNull())
    return both.select(F.explode(rows).alias("row")).select("row.*")


def _write(rows: DataFrame, keys: list[str], n: int, target: str) -> None:
    """Rows as bucketed files under current flag and bucket, by a table of the catalog that is dropped again."""
    name = f"history_{uuid.uuid4().hex}"
    rows = rows.withColumn(BUCKET, bucket_of(keys, n))
    writer = rows.write.format("parquet").partitionBy(H.CURRENT, BUCKET).bucketBy(n, *keys)
    try:
        writer.option("path", target).saveAsTable(name)
    finally:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS `{name}`")


def _as_stored(added: DataFrame, about: dict) -> DataFrame:
    """Additions with the key types and the columns of what is stored."""
    fields = {f.name: f.dataType for f in _schema(about).fields}
    kept = [F.col(f"`{c}`").cast(t).alias(c) if c in added.columns else F.lit(None).cast(t).alias(c) for c, t in fields.items()]
    return added.select(*kept, *[c for c in added.columns if c not in fields])


def commit(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    cfg: HistoryConfig,
    run_date: dt.date | str | None = None,
    close_on: str = "run_date",
    n_buckets: int = N_BUCKETS,
) -> int:
    """Merge a batch into the stored history; returns its version, the latest one for a batch without rows.

    The number of buckets is that of the first commit. Which buckets a batch
    touches, numbers below that, is what passes through the driver.
    """
    keys = list(cfg.primary_keys)
    if set(cfg.join_on) != set(keys):
        raise ConfigError("a bucketed history closes rows by its primary key")
    known = _latest(spark, path)
    added = H.merge(None, batch, cfg, run_date)
    added = materialise(_as_stored(added, known[1]) if known else added, "bucket-additions")
    n = known[1]["n"] if known else n_buckets
    found = added.groupBy(bucket_of(keys, n).alias("b")).agg(F.bool_or(F.greatest(*[F.col(f"`{k}`").isNull() for k in keys], F.lit(False))).alias("hole"))
    found = found.collect()
    if any(r["hole"] for r in found):
        raise ConfigError("a key of the batch is null")
    touched = sorted(r["b"] for r in found)
    if not touched:
        discard(added)
        return known[0] if known else -1
    aside, base = None, None
    for _ in range(commits.ATTEMPTS):
        known = _latest(spark, path)
        about = known[1] if known else {"n": n, "keys": keys, "schema": added.schema.jsonValue(), "open": [-1] * n}
        if about["n"] != n:
            raise ConfigError(f"{path} has {about['n']} buckets by now")
        version = known[0] + 1 if known else 0
        if base is None or any(about["open"][b] != base["open"][b] for b in touched) or about["schema"] != base["schema"]:
            if aside:
                commits.delete(spark, aside)
            aside, base = commits.new_aside(path), about
            if known:
                open_rows, name = open_table(spark, path, about, touched)
                try:
                    _write(_changes(open_rows, _as_stored(added, about), keys, run_date, close_on), keys, n, aside)
                finally:
                    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            else:
                _write(added, keys, n, aside)
        held = [version if b in set(touched) else at for b, at in enumerate(about["open"])]
        fields = {f.name: f for f in [*added.schema.fields, *_schema(about).fields]}
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])
        commits.write_text(spark, f"{aside}/{MANIFEST}", json.dumps({**about, "open": held, "schema": schema.jsonValue()}))
        if commits.claim(spark, aside, _folder(path, version)):
            discard(added)
            return version
    raise commits.ConflictError(f"gave up on {path}")


def read(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Whole history at a version (default: the latest)."""
    known = _latest(spark, path, as_of)
    if known is None:
        raise ConfigError(f"no committed history in {path}")
    version, about = known
    schema = _schema(about).add(BUCKET, T.IntegerType())
    reader = spark.read.schema(schema)
    parts = []
    for n in sorted({*_held(about).values()}):
        folders = [f"{_folder(path, n)}/{H.CURRENT}=1/{BUCKET}={b}" for b, at in _held(about).items() if at == n]
        parts.append(reader.option("basePath", _folder(path, n)).parquet(*folders))
    for n in (v for v in versions(spark, path) if v <= version):
        if commits.exists(spark, f"{_folder(path, n)}/{H.CURRENT}=0"):
            parts.append(reader.option("basePath", _folder(path, n)).parquet(f"{_folder(path, n)}/{H.CURRENT}=0"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows.drop(BUCKET)


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Open rows of the latest version."""
    return read(spark, path).where(F.col(H.CURRENT) == 1)
