"""Tables by name: registering stored folders, reading and querying them, and finding out what folders hold."""

from __future__ import annotations

import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.config import clean_name
from tallyfold.functions import predicates as P
from tallyfold.functions import text as X
from tallyfold.operators.history import CURRENT
from tallyfold.sources import readers, tables


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def register(spark: SparkSession, database: str, table: str, path: str, partitioned: bool = False) -> str:
    """Register a parquet folder under a name; its schema, with every column that any
    file has, and partition columns are taken from the files.

    A table of the same folder and columns stays and only learns of new files, so
    that readers find it at all times.
    """
    name = f"`{database}`.`{table}`"
    fresh = spark.read.option("mergeSchema", "true").parquet(path).schema
    kept = spark.catalog.tableExists(name) and _location(spark, name).removeprefix("file:") == path.rstrip("/").removeprefix("file:")
    if kept and {f.name: f.dataType for f in spark.table(name).schema} == {f.name: f.dataType for f in fresh}:
        spark.sql(f"REFRESH TABLE {name}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def discover(spark: SparkSession, database: str, table: str, path: str, sep: str = "|") -> str:
    """Register a folder of separated text with inferred column types."""
    name = f"`{database}`.`{table}`"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} USING csv OPTIONS (sep '{sep}', header 'false', inferSchema 'true') LOCATION '{path}'"
    )
    return name


# ---- folders of unknown layout ---------------------------------------------------------

#: What text columns may turn out to hold, narrowest first, with the shape of values that fit. A value
#: that fits a type fits the wider ones of its kind; kinds that differ meet in text.
WHOLE_DIGITS = r"^[+-]?[0-9]{1,9}$"
LONG_DIGITS = r"^[+-]?[0-9]{1,18}$"
DASHED_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SHAPES = (("int", WHOLE_DIGITS), ("bigint", LONG_DIGITS), ("double", P.NUMBER_SHAPE), ("date", DASHED_DAY))
_NUMBERS = ("int", "bigint", "double")


def wider(a: str, b: str) -> str:
    """The narrowest type that holds the values of both."""
    if a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    return "string"


def _below(root: str, file: Column) -> Column:
    """The part of a file's name below a root."""
    return F.substring_index(file, root.rstrip("/") + "/", -1)


def _layouts(spark: SparkSession, root: str) -> DataFrame:
    """(prefix, kind, partitions): the folders below a root that hold files, up to their first key=value part."""
    files = readers.file_names(spark, root).select(_below(root, F.col("file")).alias("file"))
    parts = F.split("file", "/")
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    own = F.filter(folders, lambda x: ~x.contains("="))
    named = F.transform(F.filter(folders, lambda x: x.contains("=")), lambda x: F.substring_index(x, "=", 1))
    kind = F.when(F.col("file").endswith(".parquet"), "parquet").otherwise("text")
    shown = ~X.base_name(F.col("file")).rlike("^[_.]") & ~F.exists(folders, lambda x: x.rlike("^[_.]"))
    found = files.where(shown).select(F.array_join(own, "/").alias("prefix"), kind.alias("kind"), F.array_join(named, "/").alias("partitions"))
    return found.distinct()


def text_columns(lines: DataFrame, sep: str = "|") -> DataFrame:
    """(prefix, position, type) of separated lines (prefix, value), all prefixes in one aggregate.

    Empty values fit every type; a column without any other is text.
    """
    cells = lines.select("prefix", F.posexplode(F.split("value", F.lit("\\" + sep), -1)).alias("position", "cell"))
    cell = F.nullif("cell", F.lit(""))
    fits = [F.bool_and(F.coalesce(cell.rlike(shape), F.lit(True))).alias(name) for name, shape in SHAPES]
    found = cells.groupBy("prefix", "position").agg(*fits, F.count(cell).alias("n"))
    kind = reduce(lambda rest, s: F.when(F.col(s[0]), s[0]).otherwise(rest), SHAPES[::-1], F.lit("string"))
    return found.select("prefix", "position", F.when(F.col("n") > 0, kind).otherwise("string").alias("type"))


def _shown(spark: SparkSession, name: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in spark.table(name).schema} if spark.catalog.tableExists(name) else {}


def crawl(spark: SparkSession, database: str, root: str, sep: str = "|") -> DataFrame:
    """Find the tables in a folder of many layouts; returns (table, kind, change).

    Every folder below root with files in it, or in key=value folders below it, is
    a table, named after its path. Columns of text are numbered and typed by all
    their values; columns that are known already keep their type or get a wider
    one. A table is a view of a hidden one: what changes is made aside and then
    shown at once, so readers always find a table. "changed" are tables with new or
    wider columns, "grown" those with new partitions alone. The names of folders
    and columns pass through the driver, text is read by one job.
    """
    ensure_database(spark, database)
    layouts: dict[str, tuple[str, str]] = {}
    for r in _layouts(spark, root).collect():
        if layouts.setdefault(r["prefix"], (r["kind"], r["partitions"])) != (r["kind"], r["partitions"]):
            layouts[r["prefix"]] = ("mixed", "")
    texts = [f"{root.rstrip('/')}/{unquote(p)}" for p, (kind, _) in layouts.items() if kind == "text"]
    widths: dict[str, dict[int, str]] = {}
    if texts:
        lines = spark.read.option("recursiveFileLookup", "true").text(texts)
        file = _below(root, F.col("_metadata.file_path"))
        folders = F.filter(F.split(file, "/"), lambda x: ~x.contains("="))
        prefix = F.array_join(F.slice(folders, F.lit(1), F.size(folders) - 1), "/")
        for r in text_columns(lines.select(prefix.alias("prefix"), "value"), sep).collect():
            widths.setdefault(r["prefix"], {})[r["position"]] = r["type"]
    report = []
    for prefix, (kind, partitions) in sorted(layouts.items()):
        if kind == "mixed" or (kind == "text" and prefix not in widths):
            report.append((prefix, kind, "left out"))
            continue
        table = clean_name(unquote(prefix).replace("/", "_").replace(".", "_"))
        name, path = f"`{database}`.`{table}`", f"{root.rstrip('/')}/{unquote(prefix)}"
        known = _shown(spark, name)
        parts = [p for p in partitions.split("/") if p]
        if kind == "text":
            typed = {f"_c{i}": t for i, t in sorted(widths[prefix].items())}
        else:
            read = spark.read.option("mergeSchema", "true").parquet(path)
            typed = {f.name: f.dataType.simpleString() for f in read.schema if f.name not in parts}
        old = {c: t for c, t in known.items() if c not in parts}
        simple = {n for n, _ in SHAPES} | {"string"}
        columns = {c: wider(old[c], t) if {old.get(c), t} <= simple else t for c, t in typed.items() if c in old}
        columns = {**{c: columns.get(c, t) for c, t in old.items()}, **{c: t for c, t in typed.items() if c not in old}}
        if known and columns == old:
            hidden = spark.sql(f"SHOW TBLPROPERTIES {name} ('crawled')").head()["value"]
            before = _partitions(spark, database, hidden) if parts else 0
            if parts:
                spark.sql(f"MSCK REPAIR TABLE `{database}`.`{hidden}`")
            spark.sql(f"REFRESH TABLE `{database}`.`{hidden}`")
            grown = parts and _partitions(spark, database, hidden) > before
            report.append((table, kind, "grown" if grown else "same"))
            continue
        hidden = f"{table}_{uuid.uuid4().hex[:12]}"
        ddl = ", ".join([f"`{c}` {t}" for c, t in columns.items()] + [f"`{p}` string" for p in parts])
        options = f"OPTIONS (sep '{sep}', header 'false')" if kind == "text" else ""
        by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        source = "csv" if kind == "text" else "parquet"
        spark.sql(f"CREATE TABLE `{database}`.`{hidden}` ({ddl}) USING {source} {options} {by} LOCATION '{path}'")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE `{database}`.`{hidden}`")
        before = spark.sql(f"SHOW TBLPROPERTIES {name} ('crawled')").head()["value"] if known else None
        spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('crawled' = '{hidden}') AS SELECT * FROM `{database}`.`{hidden}`")
        if before:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{before}`")
        report.append((table, kind, "changed" if known else "new"))
    return spark.createDataFrame(report, T.StructType.fromDDL("table string, kind string, change string"))


def _partitions(spark: SparkSession, database: str, table: str) -> int:
    return spark.sql(f"SHOW PARTITIONS `{database}`.`{table}`").count()


def publish_history(spark: SparkSession, database: str, table: str, path: str) -> str:
    """Give a stored slowly changing history a name.

    The folders of all versions become <table>_versions; <table> itself is a view of
    the newest one, which still prunes older open rows by their partitions.
    """
    known = tables.versions(spark, path)
    newest, gone = known[-1], tables.superseded(spark, path, known)
    stored = register(spark, database, f"{table}_versions", path, partitioned=True)
    name = f"`{database}`.`{table}`"
    shown = [f"h.`{c}`" for c in spark.table(stored).columns if c != tables.VERSION]
    valid = f"((h.{CURRENT} = 0 AND h.{tables.VERSION} <= {newest}) OR h.{tables.VERSION} = {newest})"
    left_out = ""
    if gone is not None:
        same = " AND ".join(f"h.`{c}` <=> g.`{c}`" for c in gone.columns)
        folders = f"{path.rstrip('/')}/{tables.VERSION}=*/{tables.SUPERSEDED}"
        left_out = f" LEFT ANTI JOIN parquet.`{folders}` g ON h.{CURRENT} = 0 AND {same}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(shown)} FROM {stored} h{left_out} WHERE {valid}")
    return name


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL over registered tables and over frames given by name as {name}."""
    return spark.sql(sql, **frames)
