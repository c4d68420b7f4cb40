"""Each check passes on clean rows and finds the broken ones."""

from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from crosstally.operators import quality as q


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_columns_in_one_pass(spark):
    df = spark.createDataFrame([("a", 1), (None, None), ("z", 3)], "k string, v int")
    got = rows(q.column_checks(df, "t", ["k", "v"], {"k": ["a", "b"]}))
    assert got == {("not_null:t.k", 1), ("not_null:t.v", 1), ("accepted_values:t.k", 1)}


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", None)], "k string, v int")
    assert rows(q.repeated_rows(df, ["k", "v"])) == {("a", 1, 2)}
    assert rows(q.repeated_rows(df, ["k", "v"], parts_required=True)) == {("a", 1, 2), ("c", None, 1)}


def test_conservation(spark):
    raw = spark.createDataFrame([("a", "1")] * 3 + [("b", "2"), (None, None), (None, None)], "k string, v string")
    assert q.lost_rows(raw, raw.distinct()).count() == 0
    lost = q.lost_rows(raw, raw.distinct().filter("k = 'a'")).first()
    assert (lost["raw_count"], lost["staged_count"], lost["excess_copies"]) == (6, 1, 3)
    assert q.lost_rows(raw, raw, copies_removed=False).count() == 0
    assert q.lost_rows(raw, raw.distinct(), copies_removed=False).count() == 1
    assert rows(q.lost_rows_per_group(raw, raw.distinct(), "k")) == {("a", 3, 1), (None, 2, 1)}


def test_parse_loss_and_balance(spark):
    df = spark.createDataFrame([("1", ), ("x",), (None,)], "a b string".replace("a b", "`a b`"))
    assert q.unparsed(df, {"a b": F.col("`a b`").try_cast("int")}).count() == 1
    money = spark.createDataFrame(
        [("ok", D(3), D(-1), D(2)), ("off", D(3), D(-1), D(3)), ("null", D(3), None, D(3)), ("other", D(1), D(1), D(9))],
        "s string, gross decimal(20,8), fee decimal(20,8), net decimal(20,8)",
    )
    bad = q.unbalanced(money, ["gross", "fee"], "net", F.col("s") != "other")
    assert {r["s"] for r in bad.collect()} == {"off", "null"}


def test_unresolved_references(spark):
    df = spark.createDataFrame([("a", "open"), ("a", "final"), ("b", "open"), ("b", "open"), (None, "open"), (None, "final"), ("c", "final")], "r string, k string")
    assert rows(q.unresolved(df, "r", "k", ["open"], ["final"])) == {("b", 2, 0), (None, 1, 1)}


def test_differing_keys(spark):
    left = spark.createDataFrame([("same", 1, None), ("changed", 1, 1), ("left", 1, 1), (None, 1, 1)], "k string, a int, b int")
    right = spark.createDataFrame([("same", 1, None), ("changed", 1, None), ("right", 1, 1), (None, 1, 1)], "k string, a int, b int")
    assert rows(q.differing_keys(left, right, ["k"], ["a", "b"])) == {("changed",), ("left",), ("right",), (None,)}


def test_multiset(spark):
    left = spark.createDataFrame([("a", None)] * 3 + [("b", 1)], "k string, v int")
    right = spark.createDataFrame([("a", None), ("c", 1)], "k string, v int")
    got = q.multiset_differences(left, right)
    assert rows(got.select("k", "excess")) == {("a", 2), ("b", 1), ("c", 1)}
    plain = left.exceptAll(right).count() + right.exceptAll(left).count()
    assert q.counted("x", got, "excess").first()["violations"] == plain == 4


FEES = "psp string, provider_event_id string, provider_account string, fee_type string, currency string, fee_amount int"


def test_fee_sources(spark):
    ok, twice = ("p", "1", None, "total", "USD", 5), ("p", "2", None, "total", "USD", 5)
    expected = spark.createDataFrame([ok, twice, ("p", "3", None, "total", "USD", 5)], FEES)
    actual = spark.createDataFrame([ok, twice, twice, ("p", "3", None, "total", "EUR", 5), ("p", None, None, "total", "USD", 1)], FEES)
    events = spark.createDataFrame([("p", "2"), ("p", "3")], "psp string, provider_event_id string")
    assert rows(q.homeless_fees(actual, events)) == {("p", "1"), ("p", None)}
    assert rows(q.fee_differences(expected, actual, events)) == {("p", "1"), ("p", "2"), ("p", "3"), ("p", None)}


def test_control_totals(spark):
    a = spark.createDataFrame([(1, D("1.5")), (2, None)], "k int, v decimal(20,8)")
    empty = a.filter("k > 5")
    controls = {"rows": ("count(1)", "count(1)"), "value": ("sum(v)", "sum(v)")}
    assert q.control_totals(a, a, controls).count() == 0
    assert q.control_totals(empty, empty, controls).count() == 0
    assert {r["control"] for r in q.control_totals(a, empty, controls).collect()} == {"rows", "value"}
    assert rows(q.must_not_occur(a, {"null": "v IS NULL", "big": "k > 9"})) == {("null", 1)}
