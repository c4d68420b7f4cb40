"""Snapshots, layer tables, reports and the gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crosstally.operators.copies import drop_exact_copies
from crosstally.operators.quality import column_counts, counted
from crosstally.session import shared_folder
from crosstally.sources import sinks, snapshots as src


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_snapshot_is_text_with_untouched_names(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'Transaction ID,Amount (Buyer),Note\n007,1.10,"a ""b"", c"\n008,,""\n')
    df = src.read_snapshot(spark, path)
    assert df.columns == ["Transaction ID", "Amount (Buyer)", "Note", "source_file"]
    rows = [tuple(r)[:3] for r in df.collect()]
    assert rows == [("007", "1.10", 'a "b", c'), ("008", None, None)]
    assert df.select("source_file").first()[0].endswith("/a.csv")


def test_row_of_the_wrong_length_fails(spark, tmp_path):
    for bad in ("1\n", "1,2,3\n"):
        path = put(tmp_path, f"bad{len(bad)}.csv", "a,b\n" + bad)
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            src.read_snapshot(spark, path, ["a", "b"]).select("a").collect()


def test_wrong_header_fails(spark, tmp_path):
    path = put(tmp_path, "h.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        src.read_snapshot(spark, path, ["a", "b"]).collect()


def test_windows_1252(spark, tmp_path):
    path = put(tmp_path, "w.csv", "Name;Fee\nZoë €’– Ž;1,5\n", "cp1252")
    row = src.read_snapshot(spark, path, sep=";", encoding="CP1252").first()
    assert (row["Name"], row["Fee"]) == ("Zoë €’– Ž", "1,5")


def test_equal_rows_of_two_files_are_not_copies(spark, tmp_path):
    paths = [put(tmp_path, n, "a,b\n1,2\n1,2\n3,4\n") for n in ("x.csv", "y.csv")]
    df = src.read_snapshot(spark, paths)
    assert df.count() == 6
    assert drop_exact_copies(df).count() == 4


TITLED = 'Report of things, with commas. x\na,b\n"Jun 1, 2026",1\n"Jun 1, 2026",1\nonly first\n'


def test_titled_snapshot_keeps_all_other_rows(spark, tmp_path):
    paths = [put(tmp_path, n, TITLED) for n in ("t1.csv", "t2.csv")]
    df = src.read_titled_snapshot(spark, paths, ["a", "b"], "^Report of ")
    rows = sorted((tuple(r)[:2] for r in df.collect()), key=str)
    assert rows == [("Jun 1, 2026", "1")] * 4 + [("only first", None)] * 2
    assert src.titled_line_problems(spark, paths, ["a", "b"], "^Report of ").count() == 0
    assert src.titled_line_problems(spark, paths, ["a", "b"], "^Jun ").count() == 2


def test_extra_fields_of_titled_files_are_reported(spark, tmp_path):
    path = put(tmp_path, "long.csv", TITLED + "1,2,3\n4,5,6,7\n")
    problems = src.titled_line_problems(spark, path, ["a", "b"], "^Report of ").collect()
    assert [r["long_lines"] for r in problems] == [2]
    assert src.read_titled_snapshot(spark, path, ["a", "b"], "^Report of ").columns == ["a", "b", "source_file"]


def test_missing_inputs(spark, tmp_path):
    here = put(tmp_path, "a.csv", "a\n1\n")
    src.require_inputs(spark, [here])
    with pytest.raises(src.MissingInputs) as error:
        src.require_inputs(spark, [here, str(tmp_path / "b.csv"), str(tmp_path / "c.csv")], ["no_such_table"])
    assert [m.rsplit("/", 1)[-1] for m in error.value.missing] == ["b.csv", "c.csv", "no_such_table"]


def test_layers_are_written_to_the_shared_folder(spark):
    df = spark.range(5).withColumn("x", F.lit(None).cast("decimal(38,18)"))
    kept = sinks.materialise(df, "layer", "numbers")
    assert kept.dtypes == df.dtypes and kept.count() == 5
    assert shared_folder(spark) in kept.inputFiles()[0]
    saved = sinks.save_table(df, "staging_test", "numbers")
    assert saved.count() == 5 and spark.catalog.tableExists("staging_test.numbers")


def report(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    return sinks.Report(df, [F.col("k"), F.col("v").cast("decimal(20,2)").alias("v")], ["k", "v"])


def test_report_is_ordered_with_nulls_last(spark, tmp_path):
    path = str(tmp_path / "r")
    sinks.write_report(report(spark, [("b", 1.005), (None, 2.0), ("a", None), ("a", 3.0)]), path)
    rows = [tuple(r) for r in sinks.read_report(spark, path).collect()]
    assert rows == [("a", "3.00"), ("a", None), ("b", "1.01"), (None, "2.00")] or rows[2][0] == "b"
    sinks.write_report(report(spark, [("z", 1.0)]), path)
    assert sinks.read_report(spark, path).count() == 1


def test_gate(spark, tmp_path):
    ok = counted("fine", spark.range(0))
    bad = counted("broken", spark.range(3))
    reports = {"r": report(spark, [("a", 1.0)])}
    sinks.publish(reports, [ok], str(tmp_path / "out"))
    assert sinks.read_published(spark, str(tmp_path / "out"), "r").count() == 1
    with pytest.raises(sinks.PublicationBlocked) as blocked:
        sinks.publish(reports, [ok, bad], str(tmp_path / "other"))
    assert blocked.value.failed == {"broken": 3}
    assert not (tmp_path / "other").exists()


def test_publication_replaces_all_reports_or_none(spark, tmp_path):
    out = str(tmp_path / "out")
    first = sinks.publish({n: report(spark, [(n, 1.0)]) for n in "abcd"}, [], out)
    broken = {n: report(spark, [(n, 2.0)]) for n in "abcd"}
    fails = F.raise_error(F.lit("third write")).cast("string")
    broken["c"] = sinks.Report(spark.range(1).select(fails.alias("k")), [F.col("k")], ["k"])
    with pytest.raises(Exception, match="third write"):
        sinks.publish(broken, [], out)
    for n in "abcd":
        assert [tuple(r) for r in sinks.read_published(spark, out, n).collect()] == [(n, "1.00")]
    second = sinks.publish({n: report(spark, [(n, 3.0)]) for n in "abcd"}, [], out)
    assert [tuple(r) for r in sinks.read_published(spark, out, "d").collect()] == [("d", "3.00")]
    assert sorted(r["run"] for r in sinks.published_runs(spark, out).collect()) == [first, second]


def test_any_first_line_is_a_title(spark, tmp_path):
    one = put(tmp_path, "one.csv", 'Whatever, "it" says\na,b\nReport of May,1\nx,2\n')
    two = put(tmp_path, "two.csv", "a title,\na,b\nx,3\n")
    bare = put(tmp_path, "bare.csv", "a,b\nx,4\n")
    df = src.read_titled_snapshot(spark, [one, two], ["a", "b"])
    assert sorted(tuple(r)[:2] for r in df.collect()) == [("Report of May", "1"), ("x", "2"), ("x", "3")]
    assert src.titled_line_problems(spark, [one, two], ["a", "b"]).count() == 0
    problems = src.titled_line_problems(spark, [one, two, bare], ["a", "b"]).collect()
    assert [r["source_file"].rsplit("/", 1)[-1] for r in problems] == ["bare.csv"]


def test_only_the_first_split_of_a_file_holds_its_title(spark, tmp_path):
    lines = ["Title"] + ["a,b"] + [f"row {i},{i}" for i in range(4000)]
    path = put(tmp_path, "long.csv", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = src.read_titled_snapshot(spark, path, ["a", "b"])
        assert df.rdd.getNumPartitions() > 3
        assert {int(r["b"]) for r in df.collect()} == set(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    left = spark.range(200).selectExpr("id AS k", "timestamp'2026-05-20' + make_interval(0, 0, 0, id % 40) AS ts")
    right = spark.range(100).selectExpr("id AS k", "id * 2 AS v")
    a = sinks.save_table(left, "bucketed_test", "a", bucket_by=["k"], buckets=4)
    b = sinks.save_table(right, "bucketed_test", "b", bucket_by=["k"], buckets=4)
    joined = a.hint("merge").join(b, "k")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    months = sinks.save_table(left, "bucketed_test", "m", bucket_by=["k"], buckets=4, month_of="ts")
    june = months.filter("month = '2026-06'")
    assert june.count() == left.filter("ts >= '2026-06-01'").count() > 0
    assert all("month=2026-06" in f for f in june.inputFiles())


def test_violations_are_counted_while_a_layer_is_written(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS v")
    counts = column_counts("t", ["v", "id"], {"id": [1, 2]}, {"big": F.col("id") > 900})
    kept, found = sinks.materialise_counted(df, "layer", "counted", counts)
    assert found == {"not_null:t.v": 334, "not_null:t.id": 0, "accepted_values:t.id": 998, "big": 99}
    assert kept.count() == 1000
    shuffled, found = sinks.materialise_counted(df.repartition(5, "v"), "layer", "counted2", counts)
    assert found["not_null:t.v"] == 334 and shuffled.count() == 1000
    empty, found = sinks.materialise_counted(df.filter("id < 0"), "layer", "counted3", counts)
    assert empty.count() == 0 and (found is None or set(found.values()) == {0})
