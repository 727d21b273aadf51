import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from check import compare, connect
from tallyfold.functions import text as X
from tallyfold.operators import extract, filecheck
from tallyfold.plans import batch
from tallyfold.sources import readers, sinks
from workload import extracts

PLAIN = "H|EXTRACT|20240902\n9005|1|A1\n9005|2|A2\n9019|20240902|E1\nT|9005~2|9019~2"


def status(rows, df):
    return rows(df, "file", "rec_type", "actual", "declared", "status")


def test_plain_extract(lines, rows):
    assert status(rows, filecheck.check_lines(lines(a=PLAIN))) == [
        ("a", "9005", 2, 2, "pass"),
        ("a", "9019", 1, 2, "fail"),
    ]


def test_no_footer(lines, rows):
    assert status(rows, filecheck.check_lines(lines(a="9005|1"))) == [("a", "9005", 1, 0, "fail")]


@pytest.mark.parametrize("footer", ["T|9005~1|9006", "T|9005~1|9006~x", "T|9005~1~1", "T|9005~1|", "T|9005~1.5"])
def test_bad_pair_fails_its_file_only(lines, rows, footer):
    checked = filecheck.check_lines(lines(a=f"9005|1\n{footer}", b="9005|1\nT|9005~1"))
    assert [(f, s) for f, _, _, _, s in status(rows, checked)] == [("a", "fail"), ("b", "pass")]


def test_differing_footers_fail_equal_ones_do_not(lines, rows):
    checked = filecheck.check_lines(
        lines(a="9005|1\nT|9005~1\nT|9005~1|9006~0", b="T|9005~1\n9005|1\nT|9005~1 ", c="9005|1\nT|9005~9|9005~1")
    )
    assert [(f, d, s) for f, _, _, d, s in status(rows, checked)] == [("a", 1, "fail"), ("b", 1, "pass"), ("c", 1, "pass")]


def test_absent_types(lines, rows):
    src = lines(a="9005|1\nT|9005~1|9006~3")
    assert status(rows, filecheck.check_lines(src)) == [("a", "9005", 1, 1, "pass")]
    assert status(rows, filecheck.check_lines(src, include_absent=True)) == [
        ("a", "9005", 1, 1, "pass"),
        ("a", "9006", 0, 3, "fail"),
    ]


def test_short_and_padded_lines(lines, rows):
    src = lines(a="9005\n\n \t9005|1|x 　\n  T|9005~1 \n\x0bH|h")
    assert rows(extract.records(src)) == [("a", "9005", "9005|1|x")]
    assert status(rows, filecheck.check_lines(src)) == [("a", "9005", 1, 1, "pass")]
    short = rows(extract.records(src, keep_short=True), "rec_type", "line")
    assert short == [("", ""), ("9005", "9005"), ("9005", "9005|1|x")]


def test_nothing_is_lost(lines):
    src = lines(a=PLAIN + "\nshort\n", b=PLAIN)
    tagged, recs = extract.tagged(src), extract.records(src)
    control = tagged.where(extract.is_control(F.col("rec_type"))).count()
    skipped = src.where(~F.contains("value", F.lit("|"))).count()
    assert recs.count() + control + skipped == src.count()


def test_two_files_of_a_day_are_both_kept(lines, rows, folder):
    src = lines(**{"x/one.txt": "0900|1\nT|0900~1", "x/two.txt": "0900|2\n0900|3\nT|0900~2"})
    stored = batch.segregate(src, folder, dt.date(2024, 9, 2), text=True)
    assert rows(stored, "rec_type", "extract", "value") == [
        ("0900", "one.txt", "0900|1|1"),
        ("0900", "two.txt", "0900|2|2"),
        ("0900", "two.txt", "0900|3|2"),
    ]
    assert {str(r.dt) for r in stored.collect()} == {"2024-09-02"}


def test_days_do_not_replace_each_other(spark, lines, rows, folder):
    batch.segregate(lines(a="0900|1\n0901|9\nT|0900~1"), folder, "2024-09-02")
    batch.segregate(lines(a="0900|2\nT|0900~1"), folder, "2024-09-03")
    stored = batch.segregate(lines(a="0900|3\nT|0900~1"), folder, "2024-09-02")
    assert [(str(d), t, v) for d, t, v in rows(stored, "dt", "rec_type", "line")] == [
        ("2024-09-02", "0900", "0900|3"),
        ("2024-09-03", "0900", "0900|2"),
    ]


def test_extract_names_stay_text(spark, lines, rows, folder):
    lines(**{"0042": "9005|1"}).write.partitionBy("file").text(folder)
    assert rows(readers.read_lines(spark, folder, folder="file")) == [("0042", "9005|1")]


def test_split_as_table_and_without_totals(spark, lines, rows, folder):
    src = lines(a=PLAIN)
    assert rows(batch.segregate(src, folder), "rec_type", "line", "declared") == [
        ("9005", "9005|1|A1", 2),
        ("9005", "9005|2|A2", 2),
        ("9019", "9019|20240902|E1", 2),
    ]
    recs = extract.with_declared(extract.records(src), extract.footer_totals(src))
    sinks.write_split_text(recs, folder + "-plain", with_total=False, by_file=False)
    stored = sinks.read_split(spark, folder + "-plain", text=True, by_file=False)
    assert rows(stored, "value") == [("9005|1|A1",), ("9005|2|A2",), ("9019|20240902|E1",)]


def test_split_rows_must_agree(spark, rows):
    cells = [("a", "9005", "9005|1|2"), ("a", "9005", "9005|2|2"), ("b", "9005", "9005|1|2"), ("b", "9005", "9005|2|1")]
    cells += [("c", "9005", "9005|1|1"), ("d", "9005", "9005|1|"), ("e", "9005", "9005|1|one")]
    checked = filecheck.check_split(spark.createDataFrame(cells, "file string, rec_type string, value string"))
    assert rows(checked, "file", "status") == [("a", "pass"), ("b", "fail"), ("c", "pass"), ("d", "fail"), ("e", "fail")]


def test_last_field_counts_whatever_the_width(spark, rows):
    wide = spark.createDataFrame([("a", "9005", "9005|1|x|y|z|1")], "file string, rec_type string, value string")
    assert rows(filecheck.check_split(wide), "declared", "status") == [(1, "pass")]
    assert rows(extract.reference_row(wide)) == [("a", "9005", 1)]


def test_quarantine_keeps_control_lines(lines, rows):
    split = filecheck.quarantined(lines(a="H|x\n9005||b\n9005\n9005|1|b\n|no type\n"))
    assert rows(split, "rec_type", "status", "value") == [
        ("9005", "bad", "9005"),
        ("9005", "bad", "9005||b"),
        ("9005", "good", "9005|1|b"),
        ("H", "good", "H|x"),
    ]


def test_routed_by_hour(spark, lines, rows, folder):
    batch.check_and_route(lines(a=PLAIN), folder, dt.datetime(2024, 9, 2, 7, 59))
    sinks.write_routed(sinks.read_routed(spark, folder + "/2024/09/02/07"), folder + "-even", rebalance=True)
    assert rows(sinks.read_routed(spark, folder + "-even")) == rows(sinks.read_routed(spark, folder + "/2024/09/02/07"))
    stored = sinks.read_routed(spark, folder + "/2024/09/02/07")
    assert rows(stored.groupBy("status", "rec_type").count()) == [("fail", "9019", 1), ("pass", "9005", 2)]


def test_absent_input(spark):
    for read in (readers.read_lines, readers.landing_files):
        assert read(spark, "/tmp/tallyfold/none").isEmpty()
        with pytest.raises(AnalysisException):
            read(spark, "/tmp/tallyfold/none", missing="raise").count()
    with pytest.raises(ValueError):
        readers.read_lines(spark, "/tmp", missing="ignore")
    assert not readers.table_exists(spark, "/tmp/tallyfold/none")


def test_ragged_lines_keep_their_width(spark, lines, rows):
    assert rows(readers.split_ragged(lines(a="1|2\n1|2|3|4\n"), 3)) == [
        ("", None, None, 1),
        ("1", "2", "3", 4),
        ("1", "2", None, 2),
    ]


def test_empty_and_unreadable_files_fail(spark, rows, tmp_path):
    (tmp_path / "good.txt").write_text("9005|1\nT|9005~1\n")
    (tmp_path / "empty file.txt").write_text("")
    (tmp_path / "good too.txt").write_text("9005|1\nT|9005~1\n")
    (tmp_path / "broken.gz").write_bytes(b"no archive")
    lines = readers.read_lines(spark, str(tmp_path), unreadable="skip")
    checks = filecheck.with_empty_files(filecheck.check_lines(lines), readers.file_names(spark, str(tmp_path)))
    names = F.regexp_replace(F.substring_index("file", "/", -1), "%20", " ")
    got = rows(checks.select(names, "rec_type", "actual", "status"))
    listed = readers.landing_files(spark, str(tmp_path))
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert set(listed.select("file").collect()) == set(lines.select("file").distinct().collect()) | {
        r for r in checks.select("file").collect() if r.file.endswith("broken.gz")
    }
    assert got == [
        ("broken.gz", None, 0, "fail"),
        ("empty file.txt", None, 0, "fail"),
        ("good too.txt", "9005", 1, "pass"),
        ("good.txt", "9005", 1, "pass"),
    ]
    with pytest.raises(Exception):
        readers.read_lines(spark, str(tmp_path)).count()
    with pytest.raises(ValueError):
        readers.read_lines(spark, str(tmp_path), unreadable="fix")


def test_split_route_agrees_with_the_file_check(spark, lines, rows):
    """A malformed or contradicting footer fails all types of its file on either route."""
    src = lines(good="9005|1\nT|9005~1", bad="9005|1\n9006|1\nT|9005~1|9006~x", two="9005|1\nT|9005~1\nT|9005~2")
    recs = extract.with_declared(extract.records(src), extract.footer_totals(src), extract.flagged_files(src))
    by_split = rows(filecheck.check_split(extract.split_lines(recs)), "file", "rec_type", "status")
    assert by_split == rows(filecheck.check_lines(src), "file", "rec_type", "status")
    assert [r[2] for r in by_split] == ["fail", "fail", "pass", "fail"]


def test_footers_in_one_table_say_what_two_said(spark, rows, lines):
    src = lines(
        good="9005|1\n9005|2\n9007|z\nT|9005~2|9006~1",
        twice="9005|1\nT|9005~7\nT|9005~7",
        differing="9005|1\nT|9005~1\nT|9005~2",
        broken="9005|1\n9006|1\nT|9005~x|9006~1",
        none="9005|1",
    )
    want = extract.with_declared(extract.records(src), extract.footer_totals(src), extract.flagged_files(src))
    got = extract.with_footers(extract.records(src), extract.footers(src))
    cells = ("file", "rec_type", "line", "declared")
    assert rows(got, *cells) == rows(want, *cells) and len(rows(got)) == 8


def test_scratch_tables_are_deleted(spark):
    from tallyfold.session import materialise, scratch, shared_root
    import os

    with scratch() as made:
        kept, gone = (materialise(spark.range(3), n) for n in ("kept", "gone"))
        made.remove(kept)
    assert kept.count() == 3 and not os.path.exists(gone.stored_at.removeprefix("file:"))
    assert os.path.isdir(shared_root(spark).removeprefix("file:"))


def test_totals_of_types_without_rows_are_left_out(lines, rows):
    src = lines(a="9005|1\n9005|2\nT|9000~0|9005~1|9005~2|9006~3", b="9005|1\n9006|1\nT|9005~x", c="T|9005~1", d="9005|1")
    assert rows(filecheck.declared_totals(src)) == [("a", "9005", 2), ("b", "9005", None)]


def test_footers_of_extracts_that_lack_a_type(spark, sf_dir, tmp_path):
    """Lines reach further than orders and customers: later extracts declare some that they do not hold."""
    con = connect(sf_dir)
    for t, shifted in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        far = {"customer": 0, "orders": 998_000, "lineitem": 999_000}[t]
        con.execute(f"COPY (SELECT * REPLACE ({shifted} + {far} AS {shifted}) FROM {t}) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    for name in ("raw_lines", "footer_parse", "checksum_status"):
        assert compare(spark, con, str(tmp_path), name, extracts.QUERIES[name], extracts.ORACLE[name]) == ""


def test_ends_are_stripped_by_their_bytes(spark):
    """As Python strips them, whatever characters stand there, and no end is looked for from the start of a line."""
    ends = [*X.WHITESPACE, "a", "~", "|", "é", "\x00", "\x7f", "😀", ""]
    values = [a + m + b for a in ends for b in ends for m in ("", "x y", " ", "é")]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    stripped = df.select("value", X.strip(F.col("value")).alias("both"), X.strip_left(F.col("value")).alias("left"))
    assert all((r.both, r.left) == (r.value.strip(X.WHITESPACE), r.value.lstrip(X.WHITESPACE)) for r in stripped.collect())
    plan = df.select(X.strip(F.col("value"))).select("*")._jdf.queryExecution().analyzed().toString()
    assert "AS BINARY" in plan and "right(" not in plan.split("THEN")[0]
