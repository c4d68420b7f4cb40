"""As-of joins and matching against brute force in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from crosstally.operators import asof, matching
from crosstally.operators.contracts import FX_RATE, PROVIDER_EVENT, TARIFF, conform
from crosstally.operators.quality import match_key_problems, multiset_differences
from crosstally.operators.skew import salted_join

DAY0 = date(2026, 1, 1)


def day(n):
    return DAY0 + timedelta(days=n)


def test_latest_revision_takes_the_newest_and_survives_a_hot_key(spark):
    rows = [("hot", i, i * 7 % 501) for i in range(500)] + [("a", 1, 5), ("a", 2, 5), ("b", 1, None), ("b", 2, 1)]
    df = spark.createDataFrame(rows, "k string, v int, t int").repartition(6)
    got = {r["k"]: (r["v"], r["t"]) for r in asof.latest_revision(df, ["k"], ["t"]).collect()}
    hottest = max((t, v) for k, v, t in rows if k == "hot")
    assert got == {"hot": hottest[::-1], "a": (2, 5), "b": (2, 1)}


@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_join_agrees_with_brute_force(spark, how):
    rng = random.Random(7)
    # one key holds most rows; some keys and days have no rate; NULL keys and days occur
    left = [
        (i, "USD" if rng.random() < 0.6 else rng.choice(["EUR", "GBP", "XXX", None]),
         None if rng.random() < 0.05 else day(rng.randrange(40)))
        for i in range(300)
    ]
    right = [(c, day(n), n) for c in ("USD", "EUR", "GBP") for n in sorted(rng.sample(range(5, 40), 9))]
    right += [("USD", None, 99), (None, day(0), 98)]  # in force nowhere
    right += [(c, d, r - 1) for c, d, r in right[:5]]  # of equal key and date the greatest counts
    ldf = spark.createDataFrame(left, "id int, ccy string, on date")
    rdf = spark.createDataFrame(right, "currency string, since date, rate int")
    joined = asof.asof_join(ldf, rdf, [("ccy", "currency")], F.col("on"), "since", how=how)
    assert joined.columns == ["id", "ccy", "on", "since", "rate"]
    got = {tuple(r) for r in joined.collect()}
    expected = set()
    for i, ccy, on in left:
        fitting = [(s, r) for c, s, r in right if None not in (on, ccy, c, s) and c == ccy and s <= on]
        if fitting or how == "left":
            expected.add((i, ccy, on, *(max(fitting) if fitting else (None, None))))
    assert got == expected


def test_asof_refuses_unknown_modes(spark):
    df = spark.createDataFrame([("a", DAY0)], "k string, d date")
    with pytest.raises(ValueError):
        asof.asof_join(df, df, [("k", "k")], F.col("d"), "d", how="full")


def events(spark, rows):
    schema = "provider_event_id string, psp string, provider_account string, currency string, event_timestamp_utc timestamp, amount_local_signed decimal(20,8), amount_usd_reported decimal(20,8)"
    return conform(spark.createDataFrame(rows, schema), PROVIDER_EVENT)


def test_valuation(spark):
    rates = spark.createDataFrame(
        [(day(0), "EUR", D("1.1"), None), (day(3), "EUR", D("1.2"), None)], "rate_date date, currency string, usd_rate decimal(18,10), published_at timestamp"
    )
    at = datetime(2026, 1, 3, 23, 59)
    rows = [
        ("weekend", "p", None, "EUR", at, D("10"), None),
        ("reported", "p", None, "EUR", at, D("10"), D("99")),
        ("usd", "p", None, "USD", at, D("-5"), None),
        ("early", "p", None, "EUR", datetime(2025, 12, 31), D("10"), None),
        ("timeless", "p", None, "EUR", None, D("10"), None),
        ("next day", "p", None, "EUR", datetime(2026, 1, 4), D("10"), None),
    ]
    valued = {r["provider_event_id"]: r for r in asof.value_in_usd(events(spark, rows), conform(rates, FX_RATE)).collect()}
    usd = {k: r["amount_usd_normalized"] for k, r in valued.items()}
    assert usd == {
        "weekend": D("11"), "reported": D("99"), "usd": D("-5"), "early": None, "timeless": None, "next day": D("12")
    }
    assert valued["usd"]["fx_rate_selected"] == 1 and valued["usd"]["fx_date_selected"] is None
    assert valued["reported"]["fx_date_selected"] == day(0)


def test_contract_changes_in_mid_month_and_uncovered_events_leave(spark):
    tariffs = spark.createDataFrame(
        [("p", "A", day(0), D("1"), D("0"), None), ("p", "A", day(14), D("2"), D("0"), None), ("q", "A", day(0), D("9"), D("0"), None)],
        TARIFF,
    )
    rows = [
        ("first", "p", "A", "USD", datetime(2026, 1, 14, 23), D("1"), None),
        ("second", "p", "A", "USD", datetime(2026, 1, 15), D("1"), None),
        ("before", "p", "A", "USD", datetime(2025, 12, 31, 23), D("1"), None),
        ("other", "p", "B", "USD", datetime(2026, 1, 15), D("1"), None),
        ("none", "p", None, "USD", datetime(2026, 1, 15), D("1"), None),
    ]
    found = asof.contract_in_force(events(spark, rows), tariffs)
    assert {r["provider_event_id"]: r["percent_fee"] for r in found.collect()} == {"first": 1, "second": 2}


ONE = matching.MatchRule("m", ["psp", "ref"], one_to_one=True)
ANY = matching.MatchRule("m", ["psp", "ref"])


def sides(spark, engine_refs, provider_refs):
    e = spark.createDataFrame([(f"E{i}", "p", r) for i, r in enumerate(engine_refs)], "engine_txn_id string, psp string, ref string")
    p = spark.createDataFrame([(f"P{i}", "p", r) for i, r in enumerate(provider_refs)], "provider_event_id string, psp string, ref string")
    return e.repartition(3), p.repartition(3)


def pairs(df):
    return Counter((r["engine_txn_id"], r["provider_event_id"]) for r in df.collect())


def brute(engine_refs, provider_refs, one_to_one):
    by_e, by_p = defaultdict(list), defaultdict(list)
    for i, r in enumerate(engine_refs):
        by_e[r].append(f"E{i}")
    for i, r in enumerate(provider_refs):
        by_p[r].append(f"P{i}")
    found = Counter()
    for ref in by_e.keys() & by_p.keys() - {None}:
        e, p = by_e[ref], by_p[ref]
        if (len(e) == len(p) == 1) or (not one_to_one and min(len(e), len(p)) == 1):
            found.update((a, b) for a in e for b in p)
    return found


CASES = [
    (["a"], ["a"]),
    (["a"], ["a", "a"]),
    (["a", "a"], ["a"]),
    (["a", "a"], ["a", "a"]),
    ([None, "a"], [None, "a"]),
    (["a", "b", "c", "c"], ["b", "c", "d", None]),
]


@pytest.mark.parametrize("engine_refs, provider_refs", CASES)
def test_match_cardinalities(spark, engine_refs, provider_refs):
    frames = sides(spark, engine_refs, provider_refs)
    assert pairs(matching.match(*frames, ONE)) == brute(engine_refs, provider_refs, True)
    assert pairs(matching.match(*frames, ANY)) == brute(engine_refs, provider_refs, False)


def test_match_with_hot_keys(spark):
    """A third of the rows share one reference, on one side or on both."""
    singles = [f"r{i}" for i in range(400)]
    engine_refs = singles + ["both"] * 200 + ["lone"] + ["crowd"] * 50
    provider_refs = singles[100:] + ["both"] * 200 + ["lone"] * 200 + ["crowd"]
    frames = sides(spark, engine_refs, provider_refs)
    assert pairs(matching.match(*frames, ONE)) == brute(engine_refs, provider_refs, True)
    assert pairs(matching.match(*frames, ANY)) == brute(engine_refs, provider_refs, False)
    repeated = [tuple(r) for r in matching.repeated_keys(*frames, [ANY]).collect()]
    assert repeated == [("p", "m", "p|both", 200, 200, 40000)]
    unclear = Counter((r["side"], r["id"]) for r in matching.ambiguous_rows(*frames, [ANY]).collect())
    expected = [("E", f"E{i}") for i, r in enumerate(engine_refs) if r == "both"]
    expected += [("P", f"P{i}") for i, r in enumerate(provider_refs) if r == "both"]
    assert unclear == Counter(expected)
    assert matching.ambiguous_rows(*frames, [ONE]).count() == 0


def test_pairs_keep_their_multiplicity(spark):
    """Two provider rows of one ID and key are two pairs, for the key check to find."""
    e = spark.createDataFrame([("E1", "p", "r")], "engine_txn_id string, psp string, ref string")
    p = spark.createDataFrame([("P1", "p", "r"), ("P1", "p", "r")], "provider_event_id string, psp string, ref string")
    assert pairs(matching.match(e, p, ANY)) == Counter({("E1", "P1"): 2})


def test_one_to_one_refuses_ids_of_several_pairs(spark):
    e = spark.createDataFrame([("E1", "p", "r"), ("E1", "p", "s"), ("E2", "p", "t"), ("E3", "p", "u")], "engine_txn_id string, psp string, ref string")
    p = spark.createDataFrame([("P1", "p", "r"), ("P2", "p", "s"), ("P3", "p", "t"), ("P3", "p", "u")], "provider_event_id string, psp string, ref string")
    assert pairs(matching.match(e, p, ONE)) == Counter()
    assert sum(pairs(matching.match(e, p, ANY)).values()) == 4


def test_key_problems_follow_from_one_sided_matches(spark):
    frames = sides(spark, ["a", "b", "b"], ["a", "a", "b"])
    problems = match_key_problems(matching.match(*frames, ANY), frames[1])
    assert {(r["key_type"], r["key"]) for r in problems.collect()} == {("engine_match", "E0"), ("provider_match", "P2")}


def test_rules_filter_providers_and_operations(spark):
    e = spark.createDataFrame([("E1", "p", "r1", "SALE"), ("E2", "q", "r1", "SALE"), ("E3", "p", "r2", "REFUND")], "engine_txn_id string, psp string, ref string, operation_type string")
    p = spark.createDataFrame([("P1", "p", "r1", "SALE"), ("P2", "q", "r1", "SALE"), ("P3", "p", "r2", "SALE"), ("P4", "p", "r2", "REFUND")], "provider_event_id string, psp string, ref string, operation_type string")
    rule = matching.MatchRule("m", ["psp", "ref"], psps=("p",), provider_operations=("SALE",))
    # the engine side is not filtered by operation
    assert pairs(matching.match(e, p, rule)) == Counter([("E1", "P1"), ("E3", "P3")])


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_spreads_copies_and_keeps_all_rows(spark, how):
    many = spark.createDataFrame([("hot", 1)] * 600 + [(f"k{i}", i) for i in range(100)], "k string, v int").repartition(6)
    unique = spark.createDataFrame([("hot", "H"), ("k7", "S")], "k string, w string")
    got = Counter(tuple(r) for r in salted_join(many, unique, ["k"], how).collect())
    plain = Counter(tuple(r) for r in many.join(unique, ["k"], how).collect())
    assert got == plain


def test_sorts_of_keys_start_with_what_differs(spark):
    """A sort compares eight bytes of its first column at once; rule and psp would be equal there."""
    engine, provider = sides(spark, ["a", "b", "b", None], ["a", "b", "c"])
    for rule in (ONE, ANY):
        plan = matching.match(engine, provider, rule)._jdf.queryExecution().sparkPlan().toString()
        keys = re.findall(r"Aggregate\(keys?=\[(\w+)", plan)
        assert keys and set(keys) == {"_hash"}
    both = matching.match(engine, provider, ANY)
    counted = multiset_differences(both, both)
    plan = counted._jdf.queryExecution().sparkPlan().toString()
    assert re.findall(r"Aggregate\(keys?=\[(\w+)", plan)[0] == "_hash" and "_hash" not in counted.columns
