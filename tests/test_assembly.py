"""Extracts that arrive in parts."""

import itertools
import os
import time

import pytest

from tallyfold.streaming import assembly


class Landing:
    """Part files with arrival times, in seconds after an hour ago."""

    def __init__(self, folder):
        self.path = folder + "/landing"
        self.start = int(time.time()) - 3600

    def put(self, extract, part, at, *lines):
        target = f"{self.path}/file={extract}"
        os.makedirs(target, exist_ok=True)
        with open(f"{target}/{part}.txt", "w") as f:
            f.write("".join(x + "\n" for x in lines))
        os.utime(f"{target}/{part}.txt", (self.start + at,) * 2)


@pytest.fixture
def landing(folder):
    return Landing(folder)


def run(spark, landing, folder, name="out", per_batch=None, **how):
    """Take what is there and return the checks so far and the records."""
    stream = assembly.part_stream(spark, landing.path, "file", per_batch)
    out = f"{folder}/{name}"
    query = assembly.assemble(stream, out, f"{folder}/cp_{name}", "file", 60, landed=landing.path, **how)
    query.awaitTermination()
    assert query.exception() is None
    schema = assembly.CHECKS + ", batch int"
    checks = spark.read.schema(schema).parquet(f"{out}/checks").collect()
    records = f"{out}/records"
    recs = spark.read.parquet(records).collect() if os.path.isdir(records.removeprefix("file:")) else []
    return (
        sorted((r.file, r.rec_type, r.actual, r.declared, r.status, r.reason) for r in checks),
        sorted((r.file, str(r.rec_type), r.line, r.status) for r in recs),
    )


PARTS = (["H|x", "9005|1", "9006|a"], ["9005|2", "T|9005~3|9006~1"], ["9005|3"])
WHOLE = [("e", "9005", 3, 3, "pass", "complete"), ("e", "9006", 1, 1, "pass", "complete")]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:6:3])
def test_an_extract_cut_over_three_batches_passes(spark, landing, folder, order):
    for n, part in enumerate(order):
        landing.put("e", f"p{part}", n, *PARTS[part])
        checks, records = run(spark, landing, folder)
        assert checks == (WHOLE if n == 2 else [])
    assert records == [("e", "9005", f"9005|{i}", "pass") for i in (1, 2, 3)] + [("e", "9006", "9006|a", "pass")]


def test_parts_of_one_run_in_batches_of_one_file(spark, landing, folder):
    for n, part in enumerate(PARTS):
        landing.put("e", f"p{n}", n, *part)
        landing.put("f", f"p{n}", n, *part)
    checks, records = run(spark, landing, folder, per_batch=1)
    assert checks == WHOLE + [("f", *c[1:]) for c in WHOLE] and len(records) == 8


def test_what_stays_incomplete_fails_once_after_the_limit(spark, landing, folder):
    landing.put("short", "a", 0, "9005|1", "T|9005~2")
    landing.put("footerless", "a", 0, "9005|1")
    landing.put("headed", "a", 0, "H|only")
    landing.put("broken", "a", 0, "9005|1", "T|9005~x|9006~0")
    landing.put("differing", "a", 0, "9005|1", "T|9005~1")
    landing.put("differing", "b", 1, "T|9005~2")
    landing.put("void", "a", 0)
    void = ("void", None, 0, 0, "fail", "empty")
    assert run(spark, landing, folder)[0] == [void]
    landing.put("other", "a", 40, "9005|1")
    assert run(spark, landing, folder)[0] == [void]  # a restart, and still within the limit
    landing.put("other", "b", 90, "T|9005~1")
    want = [
        ("broken", "9005", 1, 0, "fail", "bad footer"),
        ("differing", "9005", 1, 1, "fail", "bad footer"),
        ("footerless", "9005", 1, 0, "fail", "no footer"),
        ("headed", None, 0, 0, "fail", "empty"),
        ("other", "9005", 1, 1, "pass", "complete"),
        ("short", "9005", 1, 2, "fail", "counts differ"),
        void,
    ]
    assert run(spark, landing, folder)[0] == want
    landing.put("last", "a", 300, "9005|1", "T|9005~1")
    checks, records = run(spark, landing, folder)
    assert checks == sorted(want + [("last", "9005", 1, 1, "pass", "complete")], key=lambda c: c[0])
    assert ("footerless", "9005", "9005|1", "fail") in records and ("other", "9005", "9005|1", "pass") in records


def test_a_part_sent_twice_counts_once_and_late_parts_fail(spark, landing, folder):
    landing.put("e", "p0", 0, *PARTS[0])
    landing.put("e", "again", 1, *PARTS[0])
    run(spark, landing, folder)
    landing.put("e", "p1", 2, *PARTS[1])
    landing.put("e", "p2", 3, *PARTS[2])
    checks, records = run(spark, landing, folder)
    assert checks == WHOLE and len(records) == 4
    landing.put("e", "once_more", 4, *PARTS[2])
    landing.put("e", "late", 5, "9005|4", "9007|x")
    checks, records = run(spark, landing, folder)
    late = [("e", "9005", 1, 3, "fail", "after the check"), ("e", "9007", 1, 0, "fail", "after the check")]
    assert checks == sorted(WHOLE + late)
    assert ("e", "9005", "9005|4", "fail") in records and len(records) == 6


def test_parts_behind_the_time_limit_are_not_lost(spark, landing, folder):
    landing.put("new", "a", 500, "9005|1", "T|9005~1")
    run(spark, landing, folder)
    landing.put("old", "a", 0, "9005|1")
    landing.put("newer", "a", 600, "9005|1", "T|9005~1")
    checks, _ = run(spark, landing, folder)
    assert ("old", "9005", 1, 0, "fail", "no footer") in checks


def test_a_quiet_landing_zone_on_the_clock_of_the_cluster(spark, landing, folder):
    landing.put("e", "a", 0, "9005|1")
    stream = assembly.part_stream(spark, landing.path, "file")
    checks = assembly.assembled(stream, 2, clock="wall")
    query = checks.writeStream.format("memory").queryName("quiet").trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 90
        while time.time() < until and not spark.table("quiet").count():
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(r.file, r.reason) for r in spark.table("quiet").collect()] == [("e", "no footer")]
    with pytest.raises(ValueError):
        assembly.assembled(stream, 2, clock="moon")


def test_lines_are_counted_before_footers_are_unfolded(spark, landing):
    """What leaves the tasks that read does not grow with the number of lines."""
    for n in (1000, 5000):
        landing.put(f"e{n}", "p", 0, "H|x", *(f"9005|{i}" for i in range(n)), " T|9005~1|9005~%d " % n)
        stream = assembly.part_stream(spark, f"{landing.path}/file=e{n}", "file")
        query = assembly.tallies(stream).writeStream.format("memory").queryName(f"tallies_{n}").trigger(availableNow=True).start()
        query.awaitTermination()
        assert query.exception() is None
        found = [r for r in spark.table(f"tallies_{n}").collect() if r.part]
        assert len(found) < 10
        assert sum(r.actual for r in found if r.rec_type == "9005") == n
        assert sorted((r.position, r.declared) for r in found if r.position is not None) == [(-1, None), (0, 1), (1, n)]
