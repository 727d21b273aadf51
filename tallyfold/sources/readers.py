"""Reading extracts and tables, with one policy for absent input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions import text as X

SEP, QUOTE = "|", '"'
LINES = T.StructType([T.StructField("file", T.StringType()), T.StructField("value", T.StringType())])

# The fixed four-column layout of split files: type, two texts, declared total.
FOUR_COLUMNS = T.StructType(
    [
        T.StructField("_c0", T.IntegerType()),
        T.StructField("_c1", T.StringType()),
        T.StructField("_c2", T.StringType()),
        T.StructField("_c3", T.IntegerType()),
    ]
)


def _or_missing(spark: SparkSession, read, schema: T.StructType, missing: str) -> DataFrame:
    """Run a read; an absent path gives an empty frame or, by policy, the error."""
    if missing not in ("skip", "raise"):
        raise ValueError(f"missing must be skip or raise, not {missing}")
    try:
        return read()
    except AnalysisException as e:
        if missing == "skip" and (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return spark.createDataFrame([], schema)
        raise


def landing_files(spark: SparkSession, path: str, missing: str = "skip") -> DataFrame:
    """(file, modified, bytes) of every file below a folder. Contents are not read."""
    listed = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("modified", T.TimestampType()),
            T.StructField("bytes", T.LongType()),
        ]
    )

    def read():
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        about = lambda name: F.col(f"_metadata.{name}")
        return found.select(
            about("file_path").alias("file"), about("file_modification_time").alias("modified"), about("file_size").alias("bytes")
        )

    return _or_missing(spark, read, listed, missing)


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """(file) of everything Spark lists below a folder, files without a byte included,
    which scans leave out. The names come from the driver's own file index."""
    listed = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()
    names = [(f.replace("file:///", "file:/", 1),) for f in listed]
    return spark.createDataFrame(names, "file string")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """(file) of files below a folder that have no byte: all that are listed but not read."""
    return file_names(spark, path).join(landing_files(spark, path).select("file"), "file", "left_anti")


def read_lines(
    spark: SparkSession, path: str, folder: str | None = None, missing: str = "skip", unreadable: str = "raise"
) -> DataFrame:
    """(file, value) of every line. An extract is one file. With `folder`, it is all
    files below one <folder>=<name> directory; large extracts are better landed
    that way, as several tasks can write them.

    unreadable="skip" goes on without files that are corrupt or vanish meanwhile;
    they then have too few rows or none, which the file check reports.
    """
    if unreadable not in ("skip", "raise"):
        raise ValueError(f"unreadable must be skip or raise, not {unreadable}")
    skip = str(unreadable == "skip").lower()
    reader = spark.read.option("ignoreCorruptFiles", skip).option("ignoreMissingFiles", skip)

    def read():
        if folder:
            found = reader.schema(f"value string, `{folder}` string").text(path)
            return found.select(F.col(folder).alias("file"), "value")
        lines = reader.option("recursiveFileLookup", "true").text(path)
        return lines.select(F.col("_metadata.file_path").alias("file"), "value")

    return _or_missing(spark, read, LINES, missing)


def read_untyped(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated text, all columns strings named _c0, _c1, ... The width is
    that of the first line."""
    return spark.read.option("delimiter", SEP).csv(path)


def split_ragged(lines: DataFrame, width: int) -> DataFrame:
    """Lines to string columns of a given width that keeps short lines' nulls and
    shows each line's true width."""
    parts = X.fields(F.col("value"))
    return lines.select(
        *[F.get(parts, F.lit(i)).alias(f"_c{i}") for i in range(width)], F.size(parts).alias("n_fields")
    )


def read_fixed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("delimiter", SEP).schema(FOUR_COLUMNS).csv(path)


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep=SEP, header=False, quote=QUOTE, inferSchema=True)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, missing: str = "skip") -> DataFrame:
    return _or_missing(
        spark,
        lambda: spark.read.csv(path, sep=SEP, header=False, quote=QUOTE, schema=schema),
        schema,
        missing,
    )


def typed_records(
    recs: DataFrame, schema: T.StructType, malformed: str | None = None, dates: Sequence[str] = ()
) -> DataFrame:
    """Records of one type to typed columns, in the same plan as the split.

    Works on the bare line, before the declared total is appended, so widths
    agree. Unreadable values are null and the row is kept. With `malformed` a
    column of that name tells of them: null for a sound line, else the line and the
    reason, being its number of fields or the names of columns with unreadable values;
    `dates` are text columns that are to hold dates.
    """
    options = {"sep": SEP, "quote": QUOTE, "mode": "PERMISSIVE"}
    ddl = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if malformed is None:
        return recs.select(F.from_csv("line", ddl(schema.fields), options).alias("r")).select("r.*")
    if malformed in schema.names:
        raise ValueError(f"{malformed} is a column of the records")
    texts = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    whole = ddl([*schema.fields, T.StructField(malformed, T.StringType())])
    read = F.from_csv("line", whole, {**options, "columnNameOfCorruptRecord": malformed})
    rows = recs.select("line", read.alias("r"))
    # only lines that are not sound are read a second time, as texts
    plain = F.from_csv("line", ddl(texts) + ", `__more` string", options)
    cells = F.filter(F.split("line", r"\|", -1), lambda c: c.isNotNull())
    r = F.col("r")
    no_date = {c: r[c].isNotNull() & X.date_or_null(r[c]).isNull() for c in dates}
    lost = lambda c: no_date.get(c, plain[c].isNotNull() & r[c].isNull())
    bad = F.array_compact(F.array(*[F.when(lost(f.name), f.name) for f in schema.fields]))
    few = F.size(cells) != len(schema)
    reason = F.when(F.size(bad) > 0, F.concat(F.lit("unreadable: "), F.array_join(bad, ", ")))
    width = F.when(few, F.concat(F.size(cells).cast("string"), F.lit(f" fields, not {len(schema)}")))
    why = F.coalesce(F.concat_ws("; ", width, reason), F.lit(""))
    unsound = reduce(lambda a, b: a | b, no_date.values(), r[malformed].isNotNull())
    found = F.when(unsound, F.struct("line", why.alias("reason")))
    return rows.select(*[r[f.name].alias(f.name) for f in schema.fields], found.alias(malformed))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None, missing: str = "raise") -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return _or_missing(spark, lambda: reader.parquet(path), schema or T.StructType([]), missing)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table can be read and holds a row; reads at most one."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException:
        return False
