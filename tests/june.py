"""Small snapshots of one month, built backwards from its published exception rows.

Rates and the expected reports at the end are fixed values: the published ones. The raw
rows around them (orders, clocks, zones, quotes, fee components) are made up to fit.
"""

from __future__ import annotations

from pathlib import Path

from crosstally.plans import feeds

# Published rates: fixed values.
RATES = """rate_date,currency,usd_rate,published_at
2026-06-05,ARS,0.000840,2026-06-05T16:00:00Z
2026-06-08,EUR,1.090998,2026-06-08T16:00:00Z
2026-06-09,BRL,0.184648,2026-06-09T16:00:00Z
2026-06-10,BRL,0.185352,2026-06-10T16:00:00Z
2026-06-10,BRL,0.190542,2026-06-12T09:00:00Z
2026-06-10,GBP,1.288904,2026-06-10T16:00:00Z
2026-06-11,GBP,1.290138,2026-06-11T16:00:00Z
2026-06-12,BRL,0.184851,2026-06-12T16:00:00Z
2026-06-12,EUR,1.087306,2026-06-12T16:00:00Z
2026-06-12,EUR,1.0873060,2026-06-12T16:00:00Z
2026-06-15,MXN,0.055169,2026-06-15T16:00:00Z
2026-06-16,EUR,1.086632,2026-06-16T16:00:00Z
2026-06-18,BRL,0.184047,2026-06-18T16:00:00Z
2026-06-18,EUR,1.089456,2026-06-18T16:00:00Z
2026-06-18,GBP,1.292986,2026-06-18T16:00:00Z
2026-06-22,COP,0.000244,2026-06-22T16:00:00Z
2026-06-23,ARS,0.000835,2026-06-23T16:00:00Z
2026-06-24,EUR,1.083871,2026-06-24T16:00:00Z
2026-06-25,EUR,1.080211,2026-06-25T16:00:00Z
2026-06-26,EUR,1.080042,2026-06-26T16:00:00Z
2026-07-01,EUR,1.085329,2026-07-01T16:00:00Z
2026-07-02,EUR,1.088981,2026-07-02T16:00:00Z
"""

# Published fee schedule: fixed values.
SCHEDULE = """psp,account,valid_from,percent_fee,fixed_fee,fixed_fee_currency
adyen,LumoECOM_EU,2026-01-01,2.5,0.00,
adyen,LumoAPP_US,2026-01-01,2.5,0.00,
adyen,LumoAPP_US,2026-01-01,2.50,0.0,
google_play,LumoPlayMain,2026-01-01,15.0,0.00,
"""

# reference, account, currency, amount, kind, UTC time, commission, markup, engine (txn, amount, usd, rate, time)
ADYEN = [
    ("1785", "LumoECOM_EU", "EUR", "35.99", "Settled", "2026-06-18 12:48:00", "0.60", "0.30",
     ("TXN-107966", "59.99", "65.36", "1.089456", "2026-06-18T12:48:00Z")),
    ("1786", "LumoECOM_EU", "GBP", "11.00", "Settled", "2026-06-21 13:50:00", "0.20", "0.08",
     ("TXN-107967", "21.99", "28.43", "1.292986", "2026-06-21T13:50:00Z")),
    ("1787", "LumoECOM_EU", "EUR", "9.99", "Settled", "2026-07-02 10:00:00", "0.15", "0.10",
     ("TXN-107968", "9.99", "10.79", "1.080042", "2026-06-28T18:46:00Z")),
    ("1783", "LumoECOM_EU", "GBP", "21.99", "Settled", "2026-06-11 09:26:00", "0.35", "0.20",
     ("TXN-107951", "21.99", "28.34", "1.288904", "2026-06-11T09:26:00Z")),
    ("1794", "LumoECOM_EU", "EUR", "9.99", "Settled", "2026-06-16 14:30:00", "0.15", "0.10", None),
    ("1784", "LumoECOM_EU", "EUR", "9.99", "Refused", "2026-06-08 11:00:00", "", "",
     ("TXN-107959", "9.99", "10.90", "1.090998", "2026-06-08T12:39:00Z")),
    ("1791", "LumoAPP_US", "USD", "24.99", "Settled", "2026-06-24 15:05:00", "0.80", "0.30",
     ("TXN-1", "24.99", "24.99", "1", "2026-06-24T15:05:00Z")),
    ("1790", "LumoECOM_EU", "EUR", "59.99", "Settled", "2026-06-13 15:30:00", "2.00", "0.64",
     ("TXN-2", "59.99", "65.23", "1.087306", "2026-06-13T15:30:00Z")),
]

# id, kind, status, currency, exponent, minor units, local per USD, usd, UTC time, engine (txn, amount, usd, rate)
DLOCAL = [
    ("DL-90001315", "REFUND", "REFUNDED", "BRL", "2", "9995", "5.4333947307", "18.40", "2026-06-18 12:00:00",
     ("TXN-107983", "59.97", "11.04", "0.184047")),
    ("DL-90001308", "PAYMENT", "PAID", "BRL", "2", "8990", "5.2481867515", "17.13", "2026-06-10 15:33:00",
     ("TXN-107952", "89.90", "16.66", "0.185352")),
    ("DL-90001311", "PAYMENT", "PAID", "BRL", "2", "8990", "5.4157098913", "16.60", "2026-06-09 10:08:00",
     ("TXN-107963", "89.90", "89.90", "1")),
    ("DL-90001312", "PAYMENT", "PAID", "MXN", "2", "79900", "18.1261215538", "44.08", "2026-06-15 11:49:00",
     ("TXN-107964", "799.00", "799.00", "1")),
    ("DL-90001313", "PAYMENT", "PAID", "COP", "2", "19990000", "4098.3606557377", "48.78", "2026-06-22 11:36:00",
     ("TXN-107965", "199900.00", "199900.00", "1")),
    ("DL-90001318", "PAYMENT", "PAID", "ARS", "2", "1599900", "1190.4761904762", "13.45", "2026-06-05 10:03:00",
     ("TXN-107990", "15999.00", "13.44", "0.00084")),
    ("DL-90001319", "PAYMENT", "PAID", "ARS", "2", "1599900", "1197.6047904192", "13.37", "2026-06-23 09:45:00",
     ("TXN-107991", "15999.00", "13.36", "0.000835")),
    ("DL-90001310", "PAYMENT", "IN_MEDIATION", "BRL", "2", "3490", "5.4097624573", "6.45", "2026-06-14 16:16:00",
     ("TXN-107961", "34.90", "6.45", "0.184851")),
]

GOOGLE_HEADER = ",".join(feeds.GOOGLE_COLUMNS)
GOOGLE_TITLE = "Earnings report for Example (merchant account: X). All dates and times are in America/Los_Angeles."
# UTC time of charges that carry twice the contracted fee
GOOGLE_OVERCHARGED = ["09:21:00", "11:13:00", "11:49:00", "13:46:00", "14:20:00", "14:30:00"]


def engine_row(txn, psp, reference, order, operation, status, currency, amount, usd, rate, time, sku="", country=""):
    captured = time if status == "settled" else ""
    created = time.replace("T", " ").replace("Z", "") + "+00:00"
    return [
        txn, order, operation, status, psp, reference, sku, country, currency, amount, rate, time[:10], usd,
        created, captured,
    ]


def snapshots() -> dict[str, str]:
    """File name to text of all nine inputs."""
    engine, adyen, dlocal = [], [], []
    for ref, account, currency, amount, kind, time, commission, markup, booked in ADYEN:
        reference = f"862000000000{ref}"
        day, clock = time.split()
        for record in ("Authorised", kind):
            settled = record == "Settled"
            adyen.append([
                "Company", account, reference, f"ORD-{ref}", record, f"{day} {clock}", "UTC", currency, "", amount,
                commission if settled else "", markup if settled else "", currency, "", amount if settled else "", "1",
            ])
        if booked:
            txn, local, usd, rate, at = booked
            engine.append(
                engine_row(txn, "adyen", reference, f"ORD-{ref}", "SALE", "settled", currency, local, usd, rate, at)
            )
    adyen.append([
        "Company", "LumoECOM_EU", "8620000000001792", "ORD-1792", "Chargeback", "2026-06-26 16:00:00", "CET", "EUR",
        "59.99", "", "", "", "EUR", "59.99", "", "1",
    ])
    adyen.append(list(adyen[-1]))  # an exact copy
    for ident, kind, status, currency, exponent, minor, quote, usd, time, booked in DLOCAL:
        dlocal.append(
            [ident, f"INV-{ident}", kind, status, time, "XX", currency, exponent, minor, quote, usd, "0.50"]
        )
        txn, local, booked_usd, rate = booked
        operation = "REFUND" if kind == "REFUND" else "SALE"
        at = time.replace(" ", "T") + "Z"
        engine.append(
            engine_row(txn, "dlocal", ident, f"INV-{ident}", operation, "settled", currency, local, booked_usd, rate, at)
        )
    engine.append(
        engine_row("TXN-107989", "dlocal", "DL-X", "INV-X", "SALE", "settled", "CLP", "6990", "7.42", "0.001061",
                   "2026-06-20T12:59:00Z")
    )
    engine.append(
        engine_row("TXN-107950", "paypal_eu", "E0RTDA3N6XGF1YNLJ", "I1", "SALE", "settled", "EUR", "59.99", "65.75",
                   "1.096000", "2026-06-16T10:32:00Z")
    )
    engine.append(
        engine_row("TXN-107960", "paypal_us", "11EZAV8DU80K0J5GN", "I2", "SALE", "pending", "USD", "24.99", "24.99",
                   "1", "2026-06-12T14:20:00Z")
    )
    paypal_eu = [
        ["16/06/2026", "12:32:00", "CET", "Zoë €’s", "E0RTDA3N6XGF1YNLJ", "", "Website Payment",
         "Completed", "EUR", "59,99", "-2,10", "57,89", "I1"],
        ["25/06/2026", "13:00:00", "CET", "A", "LCESPNBKZNLLA8UBX", "P0", "Refund", "Refunded", "EUR", "-24,99",
         "0,00", "-24,99", "I3"],
        ["06/20/2026", "15:00:00", "CET", "B", "X2KQRFAWJMU8430TC", "P1", "Payment Reversal", "Reversed", "EUR",
         "-59,99", "0,00", "-59,99", "I4"],
    ]
    paypal_us = [
        ["06/12/2026", "07:25:00", "PST", "C, D", "11EZAV8DU80K0J5GN", "", "Website Payment", "Completed", "USD",
         "24.99", "-1.02", "23.97", "I2"],
    ]
    paypal_us.append(list(paypal_us[0]))  # an exact copy
    google = []
    for i, time in enumerate(GOOGLE_OVERCHARGED):
        hour, rest = time.split(":", 1)
        local = f"{int(hour) - 7:02d}:{rest}"
        google.append(f'"Jun 17, 2026",{local},Charge,sub_monthly,US,USD,9.99,1,USD,9.99')
        google.append(f'"Jun 17, 2026",{local},Google fee,sub_monthly,US,USD,-3.00,1,USD,-3.00')
        engine.append(
            engine_row(f"G{i}", "google_play", "", "", "SALE", "settled", "USD", "9.99", "9.99", "1",
                       f"2026-06-17T{time}Z", "sub_monthly", "US")
        )
    july = [
        '"Jul 1, 2026",02:40:10,Charge refund,sub_monthly,DE,EUR,-9.99,1.085329,USD,-10.84',
        '"Jul 1, 2026",03:50:07,Charge,sub_monthly,DE,EUR,9.99,1.085329,USD,10.84',
        '"Jul 1, 2026",03:50:07,Google fee,sub_monthly,DE,EUR,-1.50,1.085329,USD,-1.63',
    ]
    return {
        "payment_engine_log.csv": table(feeds.ENGINE_COLUMNS, engine),
        "paypal_us_activity_20260601_20260703.csv": table(feeds.PAYPAL_COLUMNS, paypal_us),
        "paypal_eu_activity_20260601_20260703.csv": table(feeds.PAYPAL_COLUMNS, paypal_eu, ";"),
        "dlocal_transactions_20260601_20260703.csv": table(feeds.DLOCAL_COLUMNS, dlocal),
        "adyen_payment_accounting_20260601_20260703.csv": table(feeds.ADYEN_COLUMNS, adyen),
        "google_play_earnings_202606.csv": "\n".join([GOOGLE_TITLE, GOOGLE_HEADER, *google]) + "\n",
        "google_play_earnings_202607_partial.csv": "\n".join([GOOGLE_TITLE, GOOGLE_HEADER, *july]) + "\n",
        "fx_rates.csv": RATES,
        "fee_schedule.csv": SCHEDULE,
    }


def table(columns, rows, sep=","):
    def cell(text):
        return f'"{text}"' if sep in text else text

    return "\n".join(sep.join(map(cell, r)) for r in [columns, *rows]) + "\n"


def write(folder: Path, files: dict[str, str] | None = None) -> feeds.Inputs:
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in (files or snapshots()).items():
        (folder / name).write_bytes(text.encode("cp1252" if "paypal_eu" in name else "utf-8"))
    return inputs(folder)


def inputs(folder: Path) -> feeds.Inputs:
    def path(name):
        return str(folder / name)

    return feeds.Inputs(
        engine=path("payment_engine_log.csv"),
        paypal_us=path("paypal_us_activity_20260601_20260703.csv"),
        paypal_eu=path("paypal_eu_activity_20260601_20260703.csv"),
        dlocal=path("dlocal_transactions_20260601_20260703.csv"),
        adyen=path("adyen_payment_accounting_20260601_20260703.csv"),
        google_play=[path("google_play_earnings_202606.csv"), path("google_play_earnings_202607_partial.csv")],
        fx_rates=path("fx_rates.csv"),
        fee_schedule=path("fee_schedule.csv"),
    )


# psp, engine_txn_id, provider_event_id, cause, engine and provider USD, impact
PUBLISHED_EXCEPTIONS = """
adyen,TXN-107966,8620000000001785:sale,amount_difference,65.36,39.21,-26.15
adyen,TXN-107967,8620000000001786:sale,amount_difference,28.43,14.22,-14.21
adyen,,8620000000001792:chargeback,chargeback_missing_in_engine,,-64.79,-64.79
adyen,TXN-107968,8620000000001787:sale,cutoff_timing,10.79,10.88,-10.79
adyen,TXN-107951,8620000000001783:sale,fx_difference,28.34,28.37,0.03
adyen,,8620000000001794:sale,provider_only,,10.86,10.86
adyen,TXN-107959,8620000000001784:sale,status_lifecycle_difference,10.90,10.90,-10.90
dlocal,TXN-107983,DL-90001315,amount_difference,-11.04,-18.40,-7.36
dlocal,TXN-107989,,engine_only,7.42,,-7.42
dlocal,TXN-107952,DL-90001308,fx_difference,16.66,17.13,0.47
dlocal,TXN-107963,DL-90001311,fx_difference,89.90,16.60,-73.30
dlocal,TXN-107964,DL-90001312,fx_difference,799.00,44.08,-754.92
dlocal,TXN-107965,DL-90001313,fx_difference,199900.00,48.78,-199851.22
dlocal,TXN-107990,DL-90001318,rounding_difference,13.44,13.45,0.01
dlocal,TXN-107991,DL-90001319,rounding_difference,13.36,13.37,0.01
dlocal,TXN-107961,DL-90001310,status_lifecycle_difference,6.45,6.45,-6.45
paypal_eu,TXN-107950,E0RTDA3N6XGF1YNLJ,fx_difference,65.75,65.19,-0.56
paypal_eu,,LCESPNBKZNLLA8UBX,refund_missing_in_engine,,-26.99,-26.99
paypal_eu,,X2KQRFAWJMU8430TC,reversal_missing_in_engine,,-65.36,-65.36
paypal_us,TXN-107960,11EZAV8DU80K0J5GN,status_lifecycle_difference,24.99,24.99,24.99
""".strip().splitlines()

# provider_event_id, account, currency, reported, expected, variance, variance in USD
PUBLISHED_FEE_EXCEPTIONS = [
    "8620000000001791:sale,LumoAPP_US,USD,1.10,0.62,0.48,0.48",
    "8620000000001790:sale,LumoECOM_EU,EUR,2.64,1.50,1.14,1.24",
    *(
        f"2026-06-17T{time}|charge|sub_monthly|US|USD,LumoPlayMain,USD,3.00,1.50,1.50,1.50"
        for time in GOOGLE_OVERCHARGED
    ),
]
