"""Extracts that arrive in parts, checked when they are whole.

An extract is all files below a folder. Its parts come in any order and in any
number of micro-batches; what is kept of it until its check is out are a few
numbers for each record type, in the state of the stream. Every micro-batch is
first reduced to one row for each part, type and task, so that a large extract
does not pass through one place. A check comes out as soon as the footer is
there and all its totals are reached, or after the time limit with whatever has
come, and then the records are routed from the parts that were counted.

A part that is delivered twice under two names counts once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyfold.functions import text as X
from tallyfold.operators import extract, filecheck
from tallyfold.sources import readers, sinks
from tallyfold.streaming.arrivals import _start

CHECKS = "file string, rec_type string, actual long, declared long, status string, reason string, parts array<string>"
#: Why a check came out as it did.
COMPLETE, COUNTS, NO_FOOTER, BAD_FOOTER, EMPTY, LATE = (
    "complete",
    "counts differ",
    "no footer",
    "bad footer",
    "empty",
    "after the check",
)
_COUNTED = "file string, part string, arrived timestamp, rec_type string, line string, n long, sign long, clock timestamp"


def _extract_of(part: Column, folder: str) -> Column:
    return F.regexp_extract(part, rf"/{folder}=([^/]+)/", 1)


def part_stream(spark: SparkSession, path: str, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """(file, part, arrived, value): lines of all files below <folder>=<extract> directories."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    part = F.col("_metadata.file_path")
    return reader.text(path).select(
        _extract_of(part, folder).alias("file"),
        part.alias("part"),
        F.col("_metadata.file_modification_time").alias("arrived"),
        "value",
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each batch counted by part and type, footers by their line.

    Besides a row for each part that only tells the time. Spark drops rows that
    are older than its watermark; the counts have no clock, so none of them is.
    """
    names = [c.split()[0] for c in _COUNTED.split(", ")]
    for batch in batches:
        t = pa.table(batch)
        by = t.group_by(["file", "part", "arrived", "rec_type", "line"], use_threads=False).aggregate([("sign", "count"), ("sign", "sum")])
        by = by.rename_columns([{"sign_count": "n", "sign_sum": "sign"}.get(c, c) for c in by.column_names])
        by = by.append_column("clock", pa.nulls(len(by), t.schema.field("arrived").type)).select(names)
        times = t.group_by(["file", "part"], use_threads=False).aggregate([("arrived", "max")])
        ticks = {c: pa.nulls(len(times), by.schema.field(c).type) for c in names}
        none = pa.array([0] * len(times), pa.int64())  # without a null, numbers stay whole in pandas
        yield from by.to_batches()
        yield from pa.table(
            {**ticks, "file": times["file"], "part": times["part"], "n": none, "sign": none, "clock": times["arrived_max"]},
            schema=by.schema,
        ).to_batches()


def tallies(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """The lines of a micro-batch as tallies of its parts and types; `sign` tells the contents of parts apart.

    Lines are counted in the tasks that read them; only footers keep their text,
    and only what was counted is unfolded. With `folder` extracts are told by it
    from the names of their parts, once for each count and not for each line.
    """
    value = F.col("value")
    lines = stream.select(
        (F.lit(None).cast("string") if folder else F.col("file")).alias("file"),
        "part",
        "arrived",
        F.when(F.contains(value, F.lit(X.FIELD)), X.record_type(X.strip_left(value))).alias("rec_type"),
        "value",
        # short enough to be summed up without overflow
        F.shiftrightunsigned(F.xxhash64(value), 28).alias("sign"),
    )
    footer = F.when(F.col("rec_type") == X.FOOTER, X.strip(value))
    counted = lines.select("file", "part", "arrived", "rec_type", footer.alias("line"), "sign").mapInArrow(_counted, _COUNTED)
    if folder:
        counted = counted.withColumn("file", _extract_of(F.col("part"), folder))
    return filecheck.entries(counted, "part", "arrived", "n", "sign", "clock", silent=True).select(
        "file",
        "part",
        "arrived",
        "rec_type",
        F.col("n").alias("n_lines"),
        "sign",
        (F.col("is_row") * F.col("n")).alias("actual"),
        "declared",
        "position",
        "bad",
        "footer_id",
        "clock",
    )


@dataclass
class Extract:
    """What is known of an extract: by type its rows, declared total and the total's position."""

    types: dict[str, list[int | None]] = field(default_factory=dict)
    parts: dict[str, list[int]] = field(default_factory=dict)
    footers: list[int] = field(default_factory=list)
    bad: bool = False
    done: bool = False
    last: int = 0

    def add(self, rows: pd.DataFrame) -> list[str]:
        """Count the parts that are new, by name and by contents; returns their names."""
        new = []
        for part, mine in rows.groupby("part", sort=True):
            sign = [int(mine["n_lines"].sum()), int(mine["sign"].sum())]
            if part in self.parts or sign in self.parts.values():
                continue
            self.parts[part] = sign
            new.append(part)
            self.bad |= bool(mine["bad"].max() == 1)
            self.footers += [int(x) for x in mine["footer_id"].dropna().unique() if int(x) not in self.footers]
            for r in mine[mine["rec_type"].notna()].itertuples():
                known = self.types.setdefault(r.rec_type, [0, None, None])
                known[0] += int(r.actual)
                if pd.notna(r.position) and (known[2] is None or r.position > known[2]):
                    known[1], known[2] = None if pd.isna(r.declared) else int(r.declared), int(r.position)
        return new

    @property
    def broken(self) -> bool:
        return self.bad or len(self.footers) > 1

    @property
    def complete(self) -> bool:
        return bool(self.footers) and not self.broken and any(a for a, *_ in self.types.values()) and all(a == (d or 0) for a, d, _ in self.types.values())

    def checks(self, file: str, types: dict[str, list[int | None]], parts: list[str], reason: str | None = None) -> pd.DataFrame:
        rows = []
        for rec_type, (actual, declared, _) in sorted(types.items()):
            if not actual:
                continue
            passed = reason is None and not self.broken and actual == (declared or 0)
            why = reason or (BAD_FOOTER if self.broken else COMPLETE if passed else COUNTS if self.footers else NO_FOOTER)
            rows.append((file, rec_type, actual, declared or 0, filecheck.PASS if passed else filecheck.FAIL, why, parts))
        if not rows and reason is None:
            rows.append((file, None, 0, 0, filecheck.FAIL, EMPTY, parts))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in CHECKS.split(", ")])


def _millis(times: pd.Series) -> int:
    return int(times.max().timestamp() * 1000)


def assembled(stream: DataFrame, limit_seconds: int, clock: str = "arrival", folder: str | None = None) -> DataFrame:
    """Checks of the extracts of a part stream, as a stream.

    `folder`, if given, must be that of the part stream.

    An extract is judged when it is complete, or when nothing of it has come for
    `limit_seconds`: with clock "arrival" by the times of all arriving files, so
    that a replay judges alike, with "wall" by the time of the cluster, so that a
    quiet landing zone does not hold a check up. Parts that come after a check are
    failed checks of their own, and so are parts that come when even that is
    forgotten, after another limit: no line is dropped for being late.
    """
    if clock not in ("arrival", "wall"):
        raise ValueError(f"clock must be arrival or wall, not {clock}")
    limit = 1000 * limit_seconds
    by_arrival = clock == "arrival"

    def judge(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        file = key[0]
        known = Extract(**json.loads(state.get[0])) if state.exists else Extract()
        if state.hasTimedOut:
            state.remove()
            if not known.done:
                yield known.checks(file, known.types, sorted(known.parts))
            return
        rows = pd.concat(list(frames))
        rows = rows[rows["clock"].isna()]
        if rows.empty:
            if by_arrival and state.exists:
                state.setTimeoutTimestamp(max(known.last, state.getCurrentWatermarkMs()) + 1)
            return
        before = {t: list(v) for t, v in known.types.items()} if known.done else None
        new = known.add(rows)
        known.last = max(known.last, _millis(rows["arrived"]))
        if before is not None:
            late = {t: [v[0] - before.get(t, [0])[0], *v[1:]] for t, v in known.types.items()}
            yield known.checks(file, late, new, LATE)
        elif known.complete:
            known.done = True
            yield known.checks(file, known.types, sorted(known.parts))
        state.update((json.dumps(asdict(known)),))
        if by_arrival:
            state.setTimeoutTimestamp(max(known.last, state.getCurrentWatermarkMs()) + 1)
        else:
            state.setTimeoutDuration(max(limit, 1))

    rows = tallies(stream, folder)
    if by_arrival:
        rows = rows.withWatermark("clock", f"{limit_seconds} seconds")
    timeout = GroupStateTimeout.EventTimeTimeout if by_arrival else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy("file").applyInPandasWithState(judge, CHECKS, "state string", "append", timeout)


def _lines_of(spark: SparkSession, parts: list[str], folder: str) -> DataFrame:
    lines = spark.read.text([unquote(p) for p in parts])
    return lines.select(F.regexp_extract(F.col("_metadata.file_path"), rf"/{folder}=([^/]+)/", 1).alias("file"), "value")


def _report_empty(spark: SparkSession, checks: DataFrame, landed: str, folder: str, out: str) -> DataFrame:
    """The checks, and failed ones for extracts of which all files are empty, unless an earlier batch reported them."""
    silent = readers.empty_files(spark, landed).select(F.regexp_extract("file", rf"/{folder}=([^/]+)/", 1).alias("file"), F.col("file").alias("part"))
    some = readers.landing_files(spark, landed).select(F.regexp_extract("file", rf"/{folder}=([^/]+)/", 1).alias("file"))
    silent = silent.join(some.distinct(), "file", "left_anti").groupBy("file").agg(F.sort_array(F.collect_set("part")).alias("parts"))
    known = readers.read_parquet(spark, f"{out}/checks", checks.schema, missing="skip").select("file")
    none = F.lit(0).cast("bigint")
    return checks.unionByName(
        silent.join(known, "file", "left_anti").select(
            "file",
            F.lit(None).cast("string").alias("rec_type"),
            none.alias("actual"),
            none.alias("declared"),
            F.lit(filecheck.FAIL).alias("status"),
            F.lit(EMPTY).alias("reason"),
            "parts",
        )
    )


def assemble(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    folder: str,
    limit_seconds: int,
    every: str | None = None,
    clock: str = "arrival",
    landed: str | None = None,
) -> StreamingQuery:
    """Check and route the extracts of a part stream when they are whole.

    Check results go to checks/batch=<n>, records to records/batch=<n>, with the
    number of the micro-batch that judged them; a replayed one overwrites its own
    folders. Records are read again from the parts that were counted, whose names
    are what passes through the driver. With `landed`, the folder the stream
    reads, extracts that have no byte are failed checks too.
    """

    def work(checks: DataFrame, batch: int) -> None:
        spark = checks.sparkSession
        target = f"{out}/checks/batch={batch}"
        checks.write.mode("overwrite").parquet(target)
        stored = spark.read.schema(checks.schema).parquet(target)
        parts = sorted(r["part"] for r in stored.select(F.explode("parts").alias("part")).distinct().collect())
        if parts:
            counted = stored.where(F.col("rec_type").isNotNull()).select("file", "rec_type", "declared", "status")
            recs = filecheck.routed(extract.records(_lines_of(spark, parts, folder)), counted)
            sinks.write_routed(recs, f"{out}/records/batch={batch}", rebalance=True)
        if landed:
            _report_empty(spark, stored.limit(0), landed, folder, out).write.mode("append").parquet(target)

    return _start(assembled(stream, limit_seconds, clock, folder), work, checkpoint, every)
