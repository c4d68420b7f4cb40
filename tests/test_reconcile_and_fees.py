"""Crafted rows for every cause, every NULL branch, and the fee rules."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from crosstally.operators import adapters, fees, quality as q, reconcile as rec
from crosstally.operators.contracts import ENGINE_EVENT, MATCH, PROVIDER_FEE, TARIFF, VALUED_EVENT, conform

JUNE = date(2026, 6, 1)
MID = datetime(2026, 6, 15, 12)
LATE = datetime(2026, 7, 2, 10)

E_DEFAULT = dict(
    engine_txn_id="E", psp="p", operation_type="SALE", status="settled", currency="EUR", fx_rate_applied=D("1.1"),
    amount_local_signed=D("10"), amount_usd_signed=D("11"), event_timestamp_utc=MID, scope_timestamp_utc=MID,
    is_financial_event=True,
)
P_DEFAULT = dict(
    provider_event_id="P", psp="p", operation_type="SALE", status="settled", currency="EUR",
    fx_rate_selected=D("1.1"), amount_local_signed=D("10"), amount_usd_normalized=D("11"), event_timestamp_utc=MID,
    is_financial_event=True,
)

# name: (engine changes or None, provider changes or None, cause, impact)
CASES = {
    "matched": ({}, {}, "matched", "0"),
    "engine only": ({}, None, "engine_only", "-11"),
    "provider only": (None, {}, "provider_only", "11"),
    "refund missing": (None, dict(operation_type="REFUND", amount_usd_normalized=D("-11")), "refund_missing_in_engine", "-11"),
    "reversal missing": (None, dict(operation_type="REVERSAL"), "reversal_missing_in_engine", "11"),
    "chargeback missing": (None, dict(operation_type="CHARGEBACK"), "chargeback_missing_in_engine", "11"),
    "operation differs": ({}, dict(operation_type="REFUND"), "unexplained", "0"),
    "operation unknown on one side": ({}, dict(operation_type=None), "unexplained", "0"),
    "currency differs": ({}, dict(currency="GBP"), "unexplained", "0"),
    "status differs": (dict(status="pending", is_financial_event=False, event_timestamp_utc=None), {}, "status_lifecycle_difference", "11"),
    "status first, then timing": (dict(status="declined"), dict(event_timestamp_utc=LATE), "status_lifecycle_difference", "-11"),
    "settled late": ({}, dict(event_timestamp_utc=LATE), "cutoff_timing", "-11"),
    "late, but not financial": (dict(is_financial_event=False), dict(event_timestamp_utc=LATE), "matched", "0"),
    "other rate": (dict(fx_rate_applied=D("1.2"), amount_usd_signed=D("12")), {}, "fx_difference", "-1"),
    "reported rate beats selected rate": ({}, dict(fx_rate_reported=D("1.3"), amount_usd_normalized=D("13")), "fx_difference", "2"),
    "unknown engine rate": (dict(fx_rate_applied=None, amount_usd_signed=D("12")), {}, "fx_difference", "-1"),
    "one cent": ({}, dict(amount_usd_normalized=D("11.01")), "rounding_difference", "0.01"),
    "one cent less": ({}, dict(amount_usd_normalized=D("10.99")), "rounding_difference", "-0.01"),
    "two cents": ({}, dict(amount_usd_normalized=D("11.02")), "amount_difference", "0.02"),
    "both rates unknown": (dict(fx_rate_applied=None), dict(fx_rate_selected=None, amount_usd_normalized=D("11.01")), "rounding_difference", "0.01"),
    "one cent, other rate": (dict(fx_rate_applied=D("1.2")), dict(amount_usd_normalized=D("11.01")), "fx_difference", "0.01"),
    "other local amount": ({}, dict(amount_local_signed=D("9"), amount_usd_normalized=D("9.9")), "amount_difference", "-1.1"),
    "local differs, value equal": ({}, dict(amount_local_signed=D("9")), "matched", "0"),
    "half a cent rounds to the event's cents": ({}, dict(amount_usd_normalized=D("11.004999")), "matched", "0"),
    "unknown value": ({}, dict(amount_usd_normalized=None), "unexplained", None),
    "unknown value, not financial": ({}, dict(amount_usd_normalized=None, is_financial_event=False), "amount_difference", "-11"),
    "unknown flag": ({}, dict(is_financial_event=None), "unexplained", "0"),
    "unknown flag, provider only": (None, dict(is_financial_event=None), "unexplained", "11"),
    "unknown engine flag": (dict(is_financial_event=None), None, "unexplained", "-11"),
    "unknown provider time": ({}, dict(event_timestamp_utc=None), "unexplained", "0"),
    "unknown scope time": (dict(scope_timestamp_utc=None), None, "unexplained", "-11"),
    "unknown time and not financial": ({}, dict(event_timestamp_utc=None, is_financial_event=False), "unexplained", "-11"),
}


@pytest.fixture(scope="module")
def detail(spark):
    engine, provider, matches = [], [], []
    for i, (e, p, *_rest) in enumerate(CASES.values()):
        if e is not None:
            engine.append({**E_DEFAULT, **e, "engine_txn_id": f"E{i}"})
        if p is not None:
            provider.append({**P_DEFAULT, **p, "provider_event_id": f"P{i}"})
        if e is not None and p is not None:
            matches.append(dict(psp="p", engine_txn_id=f"E{i}", provider_event_id=f"P{i}", match_method="ref"))
    frames = frame(spark, engine, ENGINE_EVENT), frame(spark, provider, VALUED_EVENT), frame(spark, matches, MATCH)
    return frames, rec.reconcile(*frames, [JUNE])


def frame(spark, rows, contract):
    return spark.createDataFrame([tuple(r.get(f.name) for f in contract) for r in rows], contract)


def test_causes_and_impacts(detail):
    got = {(r["engine_txn_id"] or r["provider_event_id"])[1:]: r for r in detail[1].collect()}
    assert len(got) == len(CASES)
    for i, (name, (_, _, cause, impact)) in enumerate(CASES.items()):
        row = got[str(i)]
        assert row["cause"] == cause, name
        assert row["signed_usd_impact"] == (None if impact is None else D(impact)), name
        assert row["absolute_usd_impact"] == (None if impact is None else abs(D(impact))), name


def test_all_causes_are_covered():
    named = {r.cause for r in rec.cause_rules()} | {"matched"}
    assert {c[2] for c in CASES.values()} == named and len(named) == 12


def test_summary_and_invariants(detail):
    (engine, provider, matches), rows = detail
    summary = rec.summarise(rows)
    by_cause = {r["cause"]: r for r in summary.collect()}
    assert by_cause["engine_only"]["record_count_difference"] == -1
    assert by_cause["matched"]["signed_usd_impact"] == 0
    assert q.summary_differences(rows, summary).count() == 0
    # the crafted unknown flags make totals differ from the ledgers, on both sides
    assert q.source_total_gaps(engine, provider, rows, [JUNE]).count() == 2


def test_group_of_unknown_flags_stays_unknown(spark):
    provider = frame(spark, [{**P_DEFAULT, "event_timestamp_utc": None}], VALUED_EVENT)
    empty_e, empty_m = frame(spark, [], ENGINE_EVENT), frame(spark, [], MATCH)
    total = rec.summarise(rec.reconcile(empty_e, provider, empty_m, [JUNE])).first()
    assert total["provider_record_count"] is None and total["engine_record_count"] == 0
    assert total["record_count_difference"] is None


def test_share_is_null_when_the_month_has_no_impact(spark):
    frames = frame(spark, [E_DEFAULT], ENGINE_EVENT), frame(spark, [P_DEFAULT], VALUED_EVENT)
    matches = frame(spark, [dict(psp="p", engine_txn_id="E", provider_event_id="P", match_method="m")], MATCH)
    assert rec.summarise(rec.reconcile(*frames, matches, [JUNE])).first()["absolute_impact_share_pct"] is None


def test_rows_without_ids_are_kept(spark):
    engine = frame(spark, [{**E_DEFAULT, "engine_txn_id": None}, E_DEFAULT], ENGINE_EVENT)
    provider = frame(spark, [{**P_DEFAULT, "provider_event_id": None}, {**P_DEFAULT, "psp": None}], VALUED_EVENT)
    matches = frame(spark, [dict(psp=None, engine_txn_id=None, provider_event_id=None, match_method="m")], MATCH)
    status = sorted(r["match_status"] for r in rec.pair_set(engine, provider, matches).collect())
    assert status == ["engine_only", "engine_only", "provider_only", "provider_only"]


def test_joins_of_pairs_compare_ids_first(spark):
    engine, provider = frame(spark, [E_DEFAULT], ENGINE_EVENT), frame(spark, [P_DEFAULT], VALUED_EVENT)
    matches = frame(spark, [dict(psp="p", engine_txn_id="E", provider_event_id="P", match_method="m")], MATCH)
    pairs = rec.pair_set(engine, provider, matches)
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    keys = [line.split("Join [")[1] for line in plan.splitlines() if "Join [" in line]
    assert len(keys) == 4 and all(k.startswith(("engine_txn_id", "provider_event_id")) for k in keys)
    assert pairs.columns[:3] == ["psp", "provider_event_id", "engine_txn_id"]


def test_repeated_keys_are_unexplained_not_missing(spark):
    engine = frame(spark, [{**E_DEFAULT, "engine_txn_id": f"E{i}"} for i in range(3)], ENGINE_EVENT)
    provider = frame(spark, [{**P_DEFAULT, "provider_event_id": f"P{i}"} for i in range(3)], VALUED_EVENT)
    unclear = spark.createDataFrame(
        [("p", "E", "E0"), ("p", "E", "E1"), ("p", "P", "P0"), ("p", "P", "P1")], "psp string, side string, id string"
    )
    rows = rec.reconcile(engine, provider, frame(spark, [], MATCH), [JUNE], ambiguous=unclear).collect()
    causes = {r["engine_txn_id"] or r["provider_event_id"]: r["cause"] for r in rows}
    assert len(rows) == 6 and {causes[x] for x in ("E0", "E1", "P0", "P1")} == {"unexplained"}
    assert causes["E2"] == "engine_only" and causes["P2"] == "provider_only"


def test_month_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "engine")
    frame(spark, [E_DEFAULT], ENGINE_EVENT).write.parquet(path)
    none = frame(spark, [], VALUED_EVENT), frame(spark, [], MATCH)
    for months in ([JUNE], [JUNE, date(2026, 7, 1)]):
        detail = rec.reconcile(spark.read.parquet(path), *none, months)
        plan = detail._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(" in plan


def test_several_months_in_one_pass(spark):
    provider = frame(spark, [{**P_DEFAULT, "event_timestamp_utc": LATE}], VALUED_EVENT)
    matches = frame(spark, [dict(psp="p", engine_txn_id="E", provider_event_id="P", match_method="m")], MATCH)
    rows = rec.reconcile(frame(spark, [E_DEFAULT], ENGINE_EVENT), provider, matches, [JUNE, date(2026, 7, 1), date(2026, 8, 1)])
    got = {r["report_month"]: (r["cause"], r["signed_usd_impact"]) for r in rows.collect()}
    assert got == {JUNE: ("cutoff_timing", -11), date(2026, 7, 1): ("cutoff_timing", 11)}
    with pytest.raises(ValueError):
        rec.reconcile(frame(spark, [E_DEFAULT], ENGINE_EVENT), provider, matches, [date(2026, 6, 2)])


def test_month_edges(spark):
    times = [datetime(2026, 5, 31, 23, 59, 59), datetime(2026, 6, 1), datetime(2026, 6, 30, 23, 59, 59), datetime(2026, 7, 1)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    flags = [r[0] for r in df.select(rec.in_month("t", F.lit(JUNE).cast("date"))).collect()]
    assert flags == [False, True, True, False]


def test_own_cause_rules(spark, detail):
    rules = [rec.CauseRule("large", "absolute_usd_impact > 5"), *rec.cause_rules()]
    counts = rec.classify(detail[1].drop("cause"), rules).filter("cause = 'large'").count()
    assert counts == detail[1].filter("absolute_usd_impact > 5").count() > 0


def test_engine_clocks_signs_and_flags(spark):
    schema = "txn_id string, operation_type string, status string, amount_local decimal(20,8), amount_usd decimal(20,8), created_at_utc timestamp, captured_at_utc timestamp"
    created, captured = datetime(2026, 6, 1), datetime(2026, 6, 3)
    rows = [
        ("sale", "SALE", "settled", D(1), D(2), created, captured),
        ("refund", "REFUND", "settled", D(1), D(2), created, captured),
        ("chargeback", "CHARGEBACK", "declined", D(1), D(2), created, None),
        ("pending", "SALE", "pending", D(1), D(2), created, None),
        ("uncaptured", "SALE", "settled", D(1), D(2), created, None),
        ("odd", "ADJUSTMENT", "settled", D(1), D(2), created, captured),
        ("strange", "SALE", "frozen", D(1), D(2), created, captured),
    ]
    ledger = spark.createDataFrame(rows, schema)
    for name in "order_id psp psp_reference sku country currency".split():
        ledger = ledger.withColumn(name, F.lit("x"))
    ledger = ledger.withColumn("fx_rate_applied", F.lit(1)).withColumn("fx_date_applied", F.lit(None))
    got = {r["engine_txn_id"]: r for r in adapters.engine_events(ledger).collect()}
    assert {k: int(r["amount_local_signed"]) for k, r in got.items()} == {
        "sale": 1, "refund": -1, "chargeback": -1, "pending": 1, "uncaptured": 1, "odd": 1, "strange": 1
    }
    assert {k: r["is_financial_event"] for k, r in got.items()} == {
        "sale": True, "refund": True, "chargeback": False, "pending": False, "uncaptured": True, "odd": None, "strange": None
    }
    assert {k: r["event_timestamp_utc"] for k, r in got.items()} == {
        "sale": captured, "refund": captured, "chargeback": created, "pending": None, "uncaptured": None, "odd": captured, "strange": None
    }
    assert got["pending"]["scope_timestamp_utc"] == created and got["uncaptured"]["scope_timestamp_utc"] is None


def test_lookup_text_is_quoted(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("z",), (None,)], "v string")
    got = [r[0] for r in df.select(adapters.mapped("v", {"it's": "o'k", "a\\b": "c\\d"}, "none")).collect()]
    assert got == ["o'k", "c\\d", "none", "none"]


# -- fees ---------------------------------------------------------------------------

TARIFFS = [("p", "A", date(2026, 1, 1), D("2.5"), D("0"), None), ("p", "B", date(2026, 1, 1), D("1"), D("0.30"), "EUR")]

# name: (event changes, fee currency or None, fee components, expected, cause)
FEE_CASES = {
    "same currency": ({}, "EUR", ["0.20", "0.05"], "0.25", "matched"),
    "half cent": (dict(amount_local_signed=D("40.20")), "EUR", ["1.01"], "1.01", "matched"),
    "too much": ({}, "EUR", ["0.26"], "0.25", "fee_difference"),
    "in dollars": (dict(amount_usd_normalized=D("11")), "USD", ["0.28"], "0.28", "matched"),
    "in a third currency": ({}, "GBP", ["0.25"], None, "fee_difference"),
    "fixed part": (dict(provider_account="B"), "EUR", ["0.40"], "0.40", "matched"),
    "fixed part elsewhere": (dict(provider_account="B"), "USD", ["0.40"], None, "fee_difference"),
    "no fee": ({}, None, [], None, "fee_difference"),
    "unknown component": ({}, "EUR", [None], "0.25", "fee_difference"),
    "negative principal": (dict(amount_local_signed=D("-10")), "EUR", ["0.25"], "0.25", "matched"),
}
OUT_OF_SCOPE = [
    dict(operation_type="REFUND"), dict(status="declined"), dict(is_financial_event=False),
    dict(is_financial_event=None), dict(event_timestamp_utc=LATE), dict(provider_account="C"),
    dict(provider_account=None), dict(event_timestamp_utc=None),
]


@pytest.fixture(scope="module")
def fee_detail(spark):
    default = {**P_DEFAULT, "provider_account": "A"}
    events = [{**default, "provider_event_id": f"F{i}", **c[0]} for i, c in enumerate(FEE_CASES.values())]
    events += [{**default, "provider_event_id": f"X{i}", **change} for i, change in enumerate(OUT_OF_SCOPE)]
    rows = []
    for i, (change, currency, components, *_rest) in enumerate(FEE_CASES.values()):
        for j, amount in enumerate(components):
            rows.append(dict(
                provider_event_id=f"F{i}", psp="p", provider_account=change.get("provider_account", "A"),
                fee_type=f"c{j}", currency=currency, fee_amount=None if amount is None else D(amount),
            ))
    tariffs = spark.createDataFrame(TARIFFS, TARIFF)
    events, rows = frame(spark, events, VALUED_EVENT), frame(spark, rows, PROVIDER_FEE)
    return events, tariffs, fees.reconcile_fees(events, rows, tariffs, [JUNE])


def test_expected_fees_and_causes(fee_detail):
    got = {r["provider_event_id"]: r for r in fee_detail[2].collect()}
    assert sorted(got) == [f"F{i}" for i in range(len(FEE_CASES))]
    for i, (name, (*_, expected, cause)) in enumerate(FEE_CASES.items()):
        row = got[f"F{i}"]
        assert row["expected_fee_local"] == (None if expected is None else D(expected)), name
        assert row["cause"] == cause, name


def test_fee_variance_rounds_each_side_to_cents(fee_detail):
    row = fee_detail[2].filter("provider_event_id = 'F2'").first()
    # 0.26 and 0.25 at 1.1 are 0.286 and 0.275
    assert (row["reported_fee_usd"], row["expected_fee_usd"]) == (D("0.29"), D("0.28"))
    assert row["signed_fee_variance_usd"] == D("0.01") and row["signed_fee_variance_local"] == D("0.01")


def test_fee_scope_and_summary_checks(fee_detail):
    events, tariffs, detail = fee_detail
    assert q.fee_scope_differences(events, tariffs, detail, [JUNE]).count() == 0
    assert q.fee_scope_differences(events, tariffs, detail.limit(9), [JUNE]).count() == 1
    summary = fees.summarise_fees(detail)
    # the sale without a fee has no fee currency; a NULL group key counts as a violation
    assert q.fee_summary_differences(detail, summary).count() == 1


def test_link_unique_groups(spark):
    rows = [("r1", "a", 1), ("r2", "b", 1), ("r3", "b", 1), ("r4", "c", 1), ("r5", "d", 1), ("r6", None, 1), ("r7", "e", None)]
    targets = [("t1", "a", 1), ("t2", "b", 1), ("t3", "c", 1), ("t4", "c", 1), ("t5", None, 1), ("t6", "e", None)]
    rdf = spark.createDataFrame(rows + [("hot", "h", 1)] * 300, "id string, k string, n int").repartition(4)
    tdf = spark.createDataFrame(targets + [("t7", "h", 1)], "tid string, k2 string, n2 int")
    linked = fees.link_unique(rdf, tdf, [("k", "k2"), ("n", "n2")], "tid", "link")
    got = [(r["id"], r["link"]) for r in linked.collect()]
    assert len(got) == len(rows) + 300
    assert {x for x in got if x[1]} == {("r1", "t1")}


def test_fee_components_keep_unknown_amounts(spark):
    staged = spark.createDataFrame([("e1", D("1"), None)], "ref string, commission decimal(20,8), markup decimal(20,8)").withColumn("source_file", F.lit("f"))
    spec = adapters.FeeSpec("p", "ref", "'EUR'", {"commission": "commission", "markup": "markup"}, account="'A'")
    rows = {r["fee_type"]: r["fee_amount"] for r in adapters.provider_fees(staged, spec).collect()}
    assert rows == {"commission": D("1"), "markup": None}


def test_conform_adds_missing_columns(spark):
    df = conform(spark.createDataFrame([("x",)], "psp string"), PROVIDER_FEE)
    assert df.schema == PROVIDER_FEE and df.first()["fee_amount"] is None
