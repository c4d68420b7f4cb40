"""The whole run on small snapshots: published results, gate, mutations."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

import june
from crosstally.operators import reconcile as rec
from crosstally.plans import feeds, settlement
from crosstally.sources.sinks import PublicationBlocked, check_results, read_published
from crosstally.sources.snapshots import MissingInputs, titled_line_problems

JUNE = [date(2026, 6, 1)]


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("june")
    settled = settlement.run(spark, june.write(folder / "raw"), JUNE, str(folder / "reports"))
    return settled, folder / "reports"


def text_rows(df, *columns):
    return [",".join("" if r[c] is None else str(r[c]) for c in columns) for r in df.collect()]


def test_payment_exceptions_are_the_published_rows(spark, result):
    report = read_published(spark, str(result[1]), "reconciliation_details")
    rows = text_rows(
        report, "psp", "engine_txn_id", "provider_event_id", "cause", "engine_amount_usd", "provider_amount_usd",
        "signed_usd_impact",
    )
    assert rows == june.PUBLISHED_EXCEPTIONS


def test_exception_times_and_local_amounts(spark, result):
    report = read_published(spark, str(result[1]), "reconciliation_details")
    row = report.filter("engine_txn_id = 'TXN-107968'").first()
    assert row["engine_event_timestamp_utc"] == "2026-06-28T18:46:00Z"
    assert row["provider_event_timestamp_utc"] == "2026-07-02T10:00:00Z"
    assert row["engine_amount_local"] == "9.99000000"
    pending = report.filter("engine_txn_id = 'TXN-107960'").first()
    assert pending["engine_event_timestamp_utc"] is None
    assert pending["provider_event_timestamp_utc"] == "2026-06-12T14:25:00Z"


def test_fee_exceptions_are_the_published_rows(spark, result):
    report = read_published(spark, str(result[1]), "fee_reconciliation_details")
    rows = text_rows(
        report, "provider_event_id", "provider_account", "fee_currency", "reported_fee_local", "expected_fee_local",
        "signed_fee_variance_local", "signed_fee_variance_usd",
    )
    assert rows == june.PUBLISHED_FEE_EXCEPTIONS


def test_summary_adds_up(spark, result):
    summary = read_published(spark, str(result[1]), "reconciliation_summary")
    share = summary.selectExpr("sum(cast(absolute_impact_share_pct as decimal(9,4)))").first()[0]
    assert abs(share - 100) < 0.01
    matched = summary.filter("cause = 'matched'").collect()
    assert {r["psp"] for r in matched} == {"adyen", "google_play"}
    assert all(r["signed_usd_impact"] == "0.00" for r in matched)


def test_names_survive_the_code_page(result):
    names = {r["payer_name"] for r in result[0].staged["paypal_eu"].collect()}
    assert "Zoë €’s" in names


def test_july_is_settled_from_the_same_matches(spark, result):
    s = result[0]
    detail = rec.reconcile(s.engine, s.events, s.matches, [date(2026, 7, 1)])
    causes = {r["provider_event_id"]: r["cause"] for r in detail.collect()}
    assert causes["8620000000001787:sale"] == "cutoff_timing"
    assert len(causes) == 3


def test_declared_checks_are_counted_while_layers_are_written(result):
    observed = result[0].observed
    assert set(observed) == set(settlement.declared_counts())
    again = check_results(settlement._declared_checks(replace(result[0], observed={})))
    assert {check: n for counts in observed.values() for check, n in counts.items()}.items() <= again.items()


def test_all_checks_pass(result):
    results = check_results(settlement.checks(result[0]))
    assert len(results) > 80
    assert set(results.values()) == {0}


# Each entry breaks one input in one way and names the check that must notice.
MUTATIONS = [
    # a status the feed never declared: unknown flag
    ("dlocal_transactions_20260601_20260703.csv", "IN_MEDIATION", "ON_HOLD",
     "not_null:provider_events.is_financial_event"),
    # a conflicting copy of an event
    ("paypal_us_activity_20260601_20260703.csv", "23.97,I2\n",
     "23.97,I2\n06/12/2026,07:25:01,PST,C,11EZAV8DU80K0J5GN,,Website Payment,Completed,USD,24.99,-1.02,23.97,I2\n",
     "match_keys"),
    # a zone token outside the allow-list
    ("paypal_us_activity_20260601_20260703.csv", "07:25:01,PST", "07:25:01,PDT",
     "not_null:staging.paypal_us.event_timestamp_utc"),
    # an unreadable amount
    ("adyen_payment_accounting_20260601_20260703.csv", ",35.99,0.60", ",35.99,O.60", "amount_parsing:adyen"),
    # an authorisation that never ends
    ("adyen_payment_accounting_20260601_20260703.csv", "ORD-1794,Settled", "ORD-1794,Refunded", "unresolved:adyen"),
    # gross and fee do not give net
    ("paypal_eu_activity_20260601_20260703.csv", "57,89", "57,98", "amount_balance:paypal_eu"),
    # a date outside the declared interval in either order
    ("paypal_eu_activity_20260601_20260703.csv", "25/06/2026", "25/09/2026",
     "not_null:staging.paypal_eu.event_timestamp_utc"),
    # no rate in force on the event's day
    ("fx_rates.csv", "2026-06-09,BRL", "2026-06-11,BRL", "fx_coverage"),
    # two conflicting rates of one version
    ("fx_rates.csv", "1.0873060", "1.1873060", "key:fx_rates"),
    # two charges behind one fee
    ("google_play_earnings_202606.csv", '02:21:00,Charge,sub_monthly,US,USD,9.99,1,USD,9.99\n',
     '02:21:00,Charge,sub_monthly,US,USD,9.99,1,USD,9.99\n"Jun 17, 2026",02:21:00,Charge,sub_monthly,US,USD,9.99,1,USD,9.99\n',
     "google_play_fees_linked"),
    # a type nobody declared
    ("payment_engine_log.csv", "REFUND", "REPAYMENT", "accepted_values:staging.engine.operation_type"),
    # the same transaction twice
    ("payment_engine_log.csv", "TXN-107951", "TXN-107952", "unique:engine.txn_id"),
]


def test_broken_inputs_fail_their_checks_and_block_publication(spark, tmp_path):
    files = june.snapshots()
    for name, old, new, _ in MUTATIONS:
        assert old in files[name]
        files[name] = files[name].replace(old, new)
    with pytest.raises(PublicationBlocked) as blocked:
        settlement.run(spark, june.write(tmp_path / "raw", files), JUNE, str(tmp_path / "reports"))
    unnoticed = {check for *_, check in MUTATIONS} - set(blocked.value.failed)
    assert unnoticed == set()
    assert not (tmp_path / "reports").exists()


def test_missing_inputs_are_listed_before_work(spark, tmp_path):
    paths = june.write(tmp_path / "raw")
    (tmp_path / "raw" / "fx_rates.csv").unlink()
    (tmp_path / "raw" / "payment_engine_log.csv").unlink()
    with pytest.raises(MissingInputs) as error:
        settlement.run(spark, paths, JUNE, str(tmp_path / "reports"))
    assert len(error.value.missing) == 2


def test_title_line_check(spark, tmp_path):
    files = june.snapshots()
    name = "google_play_earnings_202606.csv"
    files[name] = files[name].split("\n", 1)[1]
    paths = june.write(tmp_path / "raw", files).google_play
    problems = titled_line_problems(spark, paths, feeds.GOOGLE_COLUMNS, feeds.GOOGLE_TITLE).collect()
    assert [(r["title_lines"], r["header_lines"]) for r in problems] == [(0, 1)]
