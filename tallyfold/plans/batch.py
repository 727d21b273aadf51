"""The jobs of a daily batch, and the whole of it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import config
from tallyfold.config import ConfigError, HistoryConfig, Rule, TransposeConfig
from tallyfold.operators import extract, filecheck, quality
from tallyfold.operators.columns import clean_names, date_columns, drop_outcomes, parse_dates
from tallyfold.operators.history import history_rows, merge
from tallyfold.operators.transpose import transpose
from tallyfold.session import materialise, scratch
from tallyfold.sources import catalog, readers, sinks, tables


@dataclass(frozen=True)
class TypeJob:
    """What the batch does with one record type."""

    rec_type: str
    schema: T.StructType
    rules: Sequence[Rule] = field(default=())
    history: HistoryConfig | None = None
    history_style: str = "validity"  # or "append"
    transpose: TransposeConfig | None = None
    wide_history: HistoryConfig | None = None
    date_columns: Sequence[str] | None = None
    quarantine: bool = False  # malformed records are set aside, else only reported
    stamp: bool = True  # the run date is the load date of append histories, else the rows bring theirs


def segregate(lines: DataFrame, path: str, run_date: dt.date | str | None = None, text: bool = False) -> DataFrame:
    """Split lines by record type and store them; returns what was stored."""
    write = sinks.write_split_text if text else sinks.write_split
    with scratch():
        write(extract.with_footers(extract.records(lines), extract.footers(lines)), path, run_date)
    return sinks.read_split(lines.sparkSession, path, text, dated=run_date is not None)


def check_and_route(
    lines: DataFrame,
    path: str,
    run_ts: dt.datetime | None = None,
    files: DataFrame | None = None,
    rebalance: bool = True,
) -> DataFrame:
    """Count check of all extracts and types, then records stored by status.

    Two scans of the text: one tallies, one routes. The routed rows already carry
    their declared total, so no split copy is written in between. `files` names
    all extracts that should be there (`readers.file_names`); one that gave no
    record, being empty or unreadable, is a failed check without a type.
    `rebalance` shuffles the records by folder, so that there are as many files as
    the data need and not one for each task, status and type.
    """
    with scratch() as made:
        checks = materialise(filecheck.check_lines(lines), "checks")
        made.remove(checks)
    sinks.write_routed(filecheck.routed(extract.records(lines), checks), path, run_ts, rebalance)
    return filecheck.with_empty_files(checks, files) if files is not None else checks


def check_records(recs: DataFrame, job: TypeJob, path: str) -> tuple[DataFrame, DataFrame]:
    """Typed read and rules for one type; row outcomes are stored, then read back
    for the rule outcomes, which touch one narrow column.

    Lines that could not be read as they are carry the reason in the stored rows
    (`sinks.read_malformed`). With the job's `quarantine` they are in a folder of
    their own and neither in the rows returned nor in the rule outcomes.
    """
    dates = [c for c in date_columns(job.schema.names, job.date_columns) if isinstance(job.schema[c].dataType, T.StringType)]
    typed = readers.typed_records(extract.of_type(recs, job.rec_type), job.schema, sinks.MALFORMED, dates)
    rows = parse_dates(typed, job.date_columns)
    with scratch():
        outcomes = quality.row_outcomes(rows, job.rules)
        sinks.write_outcomes(outcomes, path, "overwrite", job.quarantine)
    schema = outcomes.drop(sinks.MALFORMED).withColumn("status", F.lit("")).schema
    stored = recs.sparkSession.read.schema(schema).parquet(path)
    if job.quarantine:
        stored = stored.where(F.col("status") != "malformed")
    rules = quality.rule_outcomes(stored.drop("status"), job.rules, job.rec_type, len(job.schema))
    return stored, rules


def load_history(
    spark: SparkSession,
    rows: DataFrame,
    cfg: HistoryConfig,
    path: str,
    run_date: dt.date | str,
    style: str = "validity",
    stamp: bool = True,
) -> DataFrame:
    """Checked rows into a history, which is returned.

    Style "validity" closes the rows a batch replaces and keeps them; "append"
    upserts under the run date, or without `stamp` under the load dates that the
    rows bring. With a database configured, the table gets a name
    there, made of style and record type. A type without rows that day changes
    nothing; before its first row there is no table, and the result is empty.
    """
    if style == "append":
        batch = history_rows(rows, run_date, stamp)
        tables.upsert_append(spark, path, batch, cfg)
        stored = tables.read_append(spark, path, batch.schema)
        if cfg.database and tables.has_rows(spark, path):
            catalog.ensure_database(spark, cfg.database)
            catalog.register(spark, cfg.database, f"append_{cfg.rec_type}", path, partitioned=True)
        return stored
    if style != "validity":
        raise ConfigError(f"unknown history style: {style}")
    batch = clean_names(drop_outcomes(rows))
    if tables.commit_history(spark, path, batch, cfg, run_date) < 0:
        return merge(None, batch, cfg, run_date)
    if cfg.database:
        catalog.ensure_database(spark, cfg.database)
        catalog.publish_history(spark, cfg.database, f"history_{cfg.rec_type}", path)
    return tables.read_history(spark, path)


class BatchError(RuntimeError):
    """Types that failed, with their messages; the others are done."""

    def __init__(self, failures: dict[str, str]):
        super().__init__("; ".join(f"{t}: {m}" for t, m in sorted(failures.items())))
        self.failures = failures


def _count(stage: str, rec_type: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), F.lit(rec_type).alias("rec_type"), "n")


def run_type(spark: SparkSession, good: DataFrame, job: TypeJob, folder: str, run_date: dt.date | str) -> list[DataFrame]:
    """What a batch does with one type, from records that passed the file check; row counts of its stages."""
    rows, rules = check_records(good, job, f"{folder}/outcomes")
    passed = rows.where(F.col("status") == "pass").drop("status")
    counts = [
        _count("rows_pass", job.rec_type, passed),
        _count("rows_fail", job.rec_type, rows.where(F.col("status") == "fail")),
        _count("rules_fail", job.rec_type, rules.where(F.col("outcome") == quality.FAILED)),
    ]
    if job.quarantine:
        counts.append(_count("rows_malformed", job.rec_type, sinks.read_malformed(spark, f"{folder}/outcomes")))
    if job.history:
        history = load_history(spark, passed, job.history, f"{folder}/history", run_date, job.history_style, job.stamp)
        counts.append(_count("history", job.rec_type, history))
    if job.transpose:
        sinks.write_wide(transpose(passed, job.transpose), f"{folder}/wide")
        wide = spark.read.parquet(f"{folder}/wide")
        counts.append(_count("wide", job.rec_type, wide))
        if job.wide_history:
            kept = load_history(spark, wide, job.wide_history, f"{folder}/wide_history", run_date, "append")
            counts.append(_count("wide_history", job.rec_type, kept))
    return counts


def run(
    spark: SparkSession,
    lines: DataFrame,
    out: str,
    jobs: Sequence[TypeJob],
    run_date: dt.date | str,
    files: DataFrame | None = None,
    parallel: int = 10,
    on_error: str = "raise",
) -> DataFrame:
    """Whole batch; returns (stage, rec_type, n) with the row counts of each stage.

    A type of which no row passed leaves its histories as they are.

    Splitting, checking and routing handle all types in one job. What follows is
    per type, as schemas differ: `parallel` types at a time, each in a scheduler
    pool of its own (fair among them where spark.scheduler.mode is FAIR), so that
    small types fill the gaps of large ones. A type that fails does not stop the
    others; when they are done it is an error, or with on_error="report" a stage
    "error" of the result, its message in <out>/<type>/error.
    """
    if on_error not in ("raise", "report"):
        raise ValueError(f"on_error must be raise or report, not {on_error}")
    checks = check_and_route(lines, f"{out}/routed", files=files)
    routed = sinks.read_routed(spark, f"{out}/routed")
    good = routed.where(F.col("status") == filecheck.PASS)
    by_status = F.concat(F.lit("route_"), F.col("status")).alias("stage")
    summary = routed.groupBy(by_status, "rec_type").agg(F.count(F.lit(1)).alias("n"))
    by_status = F.concat(F.lit("check_"), F.col("status")).alias("stage")
    summary = summary.unionByName(checks.groupBy(by_status, "rec_type").agg(F.count(F.lit(1)).alias("n")))

    def work(job: TypeJob) -> list[DataFrame] | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"type_{job.rec_type}")
        try:
            return run_type(spark, good, job, f"{out}/{job.rec_type}", run_date)
        except Exception as e:  # whatever stops a type is reported, below
            return e
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(parallel, len(jobs)))) as pool:
        # each job has a copy of the caller's local properties
        started = [pool.submit(inheritable_thread_target(spark)(work), job) for job in jobs]
        done = [s.result() for s in started]
    failures = {job.rec_type: f"{type(e).__name__}: {e}" for job, e in zip(jobs, done) if isinstance(e, Exception)}
    if failures and on_error == "raise":
        raise BatchError(failures) from next(e for e in done if isinstance(e, Exception))
    for rec_type, message in failures.items():
        told = spark.createDataFrame([(rec_type, message)], "rec_type string, message string")
        told.write.mode("overwrite").json(f"{out}/{rec_type}/error")
        summary = summary.unionByName(_count("error", rec_type, told))
    for counts in done:
        for df in counts if isinstance(counts, list) else []:
            summary = summary.unionByName(df)
    return summary


def jobs_of(
    spark: SparkSession,
    schemas: str,
    rules: str,
    histories: str | None = None,
    transposes: str | None = None,
    wide_histories: str | None = None,
    types: Sequence[str] | None = None,
    quarantine: bool = True,
) -> list[TypeJob]:
    """The jobs of a batch from its JSON configs, given by their paths.

    Schemas say which types there are; `types` picks some. Each must have rules,
    if only an empty list; histories and transposes are for the types they name. A
    history of style "append" or without stamp has these in its settings, as
    "style" and "stamp".
    """
    read = lambda path: config.read_json(spark, path) if path else {}
    columns, checks, kept, turned, wide = map(read, (schemas, rules, histories, transposes, wide_histories))

    def job(rec_type: str) -> TypeJob:
        of = lambda settings, build: build(settings, rec_type) if rec_type in settings else None
        own = kept.get(rec_type, {})
        return TypeJob(
            rec_type.removeprefix("rec_type_"),
            config.schema_of(columns, rec_type),
            config.rules_of(checks, rec_type, required=True),
            of(kept, HistoryConfig.of),
            own.get("style", "validity"),
            of(turned, TransposeConfig.of),
            of(wide, HistoryConfig.of),
            quarantine=quarantine,
            stamp=own.get("stamp", True),
        )

    return [job(config.type_key(columns, t)) for t in (columns if types is None else types)]
