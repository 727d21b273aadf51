"""Files delivered again under other names."""

import os
import time

from pyspark.sql import functions as F

from tallyfold.sources import sinks
from tallyfold.streaming import arrivals, deliveries


def put(folder, name, text, at):
    os.makedirs(f"{folder}/landing", exist_ok=True)
    path = f"{folder}/landing/{name}"
    with open(path, "w") as f:
        f.write(text)
    moment = time.time() - 10 * 86400 + at
    os.utime(path, (moment, moment))


def take(spark, folder):
    for start in (
        lambda: deliveries.log_deliveries(spark, f"{folder}/landing", f"{folder}/ledger", f"{folder}/cp1", "1 hour", files_per_batch=1),
        lambda: deliveries.ingest_ledger(spark, f"{folder}/ledger", f"{folder}/out", f"{folder}/cp2"),
    ):
        query = start()
        query.awaitTermination()
        assert query.exception() is None
    found = deliveries.report(spark, f"{folder}/landing", f"{folder}/ledger", "1 hour").collect()
    base = lambda f: f and f.rsplit("/", 1)[1]
    lines = sinks.read_routed(spark, f"{folder}/out/records").collect()
    return sorted((base(r.file), r.status, base(r.like)) for r in found), sorted((base(r.file), r.line) for r in lines)


def test_a_file_sent_twice_counts_once_and_late_ones_are_reported(spark, folder):
    put(folder, "a 1.txt", "9005|1\nT|9005~1\n", 0)
    put(folder, "b.txt", "9005|2\nT|9005~1\n", 60)
    assert take(spark, folder)[0] == [("a 1.txt", "taken", None), ("b.txt", "taken", None)]
    put(folder, "c.txt", "9005|1\nT|9005~1\n", 120)  # as a
    put(folder, "d.txt", "9005|3\nT|9005~1\n", 90_000)
    take(spark, folder)
    put(folder, "e.txt", "9005|4\nT|9005~1\n", 200)  # a day behind
    put(folder, "f.txt", "9005|3\nT|9005~1\n", 90_060)  # as d
    files, lines = take(spark, folder)
    assert [f[1:] for f in files] == [
        ("taken", None),
        ("taken", None),
        ("repeated", "a 1.txt"),
        ("taken", None),
        ("late", None),
        ("repeated", "d.txt"),
    ]
    assert [line for _, line in lines] == ["9005|1", "9005|2", "9005|3"]
    put(folder, "g.txt", "9005|5\n", 90_100)
    waiting = deliveries.report(spark, f"{folder}/landing", f"{folder}/ledger", "1 hour").where("status = 'pending'")
    assert [r.file.rsplit("/", 1)[1] for r in waiting.collect()] == ["g.txt"]


def test_names_of_extracts_are_taken_from_counts_and_not_from_lines(spark, folder, monkeypatch):
    """Parts of an extract are checked and routed together, and no line has its path searched for the name."""
    for name, text in (("a b/1", "9005|1\n9006|x\n"), ("a b/2", "9005|2\nT|9005~2|9006~2\n"), ("c/1", " 9005|3 \nT|9005~1\nlone\n")):
        path = f"{folder}/in/file={name}.txt"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    plans, write = [], sinks.write_routed

    def noted(recs, *args, **kwargs):
        plans.append(recs._jdf.queryExecution().optimizedPlan().toString())
        write(recs, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_routed", noted)
    (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/in")
        .select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), F.lit("").alias("digest"))
        .write.parquet(f"{folder}/ledger"))
    for start in (
        lambda out: deliveries.ingest_ledger(spark, f"{folder}/ledger", out, f"{out}-cp", "file"),
        lambda out: arrivals.ingest(arrivals.line_stream(spark, f"{folder}/in"), out, f"{out}-cp", folder="file"),
    ):
        out = f"{folder}/out{len(plans)}"
        query = start(out)
        query.awaitTermination()
        assert query.exception() is None
        name = lambda f: f.replace("%20", " ")
        got = sorted((name(r.file), r.rec_type, r.line, r.declared, r.status) for r in sinks.read_routed(spark, f"{out}/records").collect())
        assert got == [
            ("a b", "9005", "9005|1", 2, "pass"),
            ("a b", "9005", "9005|2", 2, "pass"),
            ("a b", "9006", "9006|x", 2, "fail"),
            ("c", "9005", "9005|3", 1, "pass"),
        ]
        checks = spark.read.parquet(f"{out}/checks").collect()
        assert sorted((name(r.file), r.rec_type, r.actual) for r in checks) == [("a b", "9005", 2), ("a b", "9006", 1), ("c", "9005", 1)]
    assert len(plans) == 2 and not any("regexp_extract" in p for p in plans)
