import pytest
from pyspark.sql import functions as F

from tallyfold.config import HistoryConfig
from tallyfold.operators import extract, filecheck
from tallyfold.sources import readers, sinks, tables
from tallyfold.streaming import arrivals


def land(spark, path, name, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
    df.write.text(f"{path}/{name}")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


FILES = {
    "one": ["H|x", "9005|1", "9005|2", "T|9005~2"],
    "two": ["9005|3", "9019|4", "T|9005~1|9019~2"],
    "three": ["9019|5", "T|9019~1"],
}


def test_stream_equals_batch_and_takes_files_once(spark, rows, folder):
    landing, out = f"{folder}/landing", f"{folder}/out"
    land(spark, landing, "one", *FILES["one"])
    land(spark, landing, "two", *FILES["two"])
    drain(arrivals.ingest(arrivals.line_stream(spark, landing, 1), out, f"{folder}/cp"))
    drain(arrivals.ingest(arrivals.line_stream(spark, landing, 1), out, f"{folder}/cp"))
    land(spark, landing, "three", *FILES["three"])
    drain(arrivals.ingest(arrivals.line_stream(spark, landing, 1), out, f"{folder}/cp"))

    lines = readers.read_lines(spark, landing)
    checks = filecheck.check_lines(lines)
    cells = ("file", "rec_type", "line", "declared", "status")
    got = sinks.read_routed(spark, f"{out}/records")
    assert rows(got, *cells) == rows(filecheck.routed(extract.records(lines), checks), *cells)
    checked = spark.read.parquet(f"{out}/checks")
    assert rows(checked, *checks.columns) == rows(checks)
    assert {r.batch for r in checked.select("batch").collect()} == {0, 1, 2}


def test_replayed_batch_changes_nothing(spark, rows, folder):
    landing, out = f"{folder}/landing", f"{folder}/out"
    land(spark, landing, "one", *FILES["one"])
    for attempt in ("cp1", "cp2"):  # a lost checkpoint replays batch 0
        drain(arrivals.ingest(arrivals.line_stream(spark, landing), out, f"{folder}/{attempt}"))
    assert sinks.read_routed(spark, f"{out}/records").count() == 2


def test_arrival_log(spark, rows, folder):
    landing = f"{folder}/landing"
    land(spark, landing, "one", "a|b")
    drain(arrivals.log_arrivals(spark, landing, f"{folder}/log", f"{folder}/cp"))
    land(spark, landing, "two", "a|b")
    drain(arrivals.log_arrivals(spark, landing, f"{folder}/log", f"{folder}/cp"))
    log = spark.read.parquet(f"{folder}/log")
    assert rows(log.select(F.substring_index("key", "/", 1), "bucket")) == [("one", "landing"), ("two", "landing")]
    files = spark.createDataFrame([("s3://zone/in/a.txt", "2024-09-02 07:00:00")], "file string, m string")
    message = arrivals.arrival_log(files.select("file", F.col("m").cast("timestamp").alias("modified")), "s3://zone/")
    assert message.head().message == "in/a.txt uploaded in zone at 2024-09-02T07:00:00Z"


@pytest.mark.parametrize("per_batch", [1, 10])
def test_upserts_do_not_depend_on_arrival(spark, rows, folder, per_batch):
    cfg = HistoryConfig("t", ("k",), "n")
    schema = "k int, n int, dt date"
    cells = [(k, n, d) for k in range(5) for n, d in ((k, "2024-01-01"), (9 - k, "2024-01-01"), (3, "2024-01-02"))]
    src = spark.createDataFrame(cells, "k int, n int, d string").select("k", "n", F.col("d").cast("date").alias("dt"))
    src.repartition(4).write.parquet(f"{folder}/in")
    stream = arrivals.parquet_stream(spark, f"{folder}/in", src.schema, per_batch)
    drain(arrivals.upsert_arrivals(stream, f"{folder}/table", cfg, f"{folder}/cp"))
    best = src.groupBy("dt", "k").agg(F.max("n").alias("n"))
    assert rows(spark.read.schema(schema).parquet(f"{folder}/table"), "dt", "k", "n") == rows(best)


def test_timed_trigger_runs(spark, folder):
    land(spark, f"{folder}/in", "one", *FILES["one"])
    query = arrivals.ingest(arrivals.line_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/cp", every="1 second")
    query.processAllAvailable()
    query.stop()
    assert sinks.read_routed(spark, f"{folder}/out/records").count() == 2
    assert tables.versions(spark, f"{folder}/none") == []
