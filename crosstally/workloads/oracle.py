"""The same queries in SQL over the given tables, written apart from the Spark code.

Where the Spark side unions, counts and joins in steps, the SQL uses the textbook form:
full outer joins, ranking windows, correlated lateral joins, EXCEPT ALL.
"""

from __future__ import annotations

_BASE = """
base AS (
  SELECT o_orderkey AS k, n_nationkey AS n, n_name AS country, 'psp_' || (o_orderkey % 3) AS psp,
    CAST(o_totalprice AS DECIMAL(20,2)) AS amount,
    CASE n_nationkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'BRL' END AS currency,
    CAST(CASE n_nationkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.1 WHEN 2 THEN 1.3 ELSE 0.2 END AS DECIMAL(6,4)) AS rate,
    TIMESTAMP '2026-05-16 12:00:00' + to_days(CAST(o_orderkey % 61 AS INTEGER)) AS ts,
    CASE WHEN o_orderkey % 5 = 1 THEN 'REFUND' WHEN o_orderkey % 7 = 2 THEN 'CHARGEBACK' ELSE 'SALE' END AS op,
    CASE WHEN o_orderstatus <> 'P' THEN 'settled' WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'declined' END AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_ENGINE = """
e AS (
  SELECT 'E' || k AS engine_txn_id, psp, 'R' || k AS psp_reference, 'O' || k AS order_id, op AS operation_type,
    status, country, 'sku_' || (k % 7) AS sku, currency, CAST(ts AS DATE) AS fx_date_applied, rate AS fx_rate_applied,
    CASE WHEN op = 'SALE' THEN amount ELSE -amount END AS amount_local_signed,
    CASE WHEN op = 'SALE' THEN 1 ELSE -1 END * round(amount * rate, 2) AS amount_usd_signed,
    CASE status WHEN 'settled' THEN ts WHEN 'declined' THEN ts - INTERVAL 1 HOUR END AS event_ts,
    CASE WHEN status = 'settled' THEN ts ELSE ts - INTERVAL 1 HOUR END AS scope_ts,
    status = 'settled' AS is_financial_event
  FROM base WHERE k % 11 <> 3
)"""

_PROVIDER = """
feed AS (
  SELECT *, CASE WHEN k % 29 = 7 THEN rate * CAST(1.01 AS DECIMAL(4,2)) END AS quoted_rate,
    CASE WHEN op = 'SALE' THEN 1 ELSE -1 END
      * (amount - CASE WHEN k % 31 = 6 THEN 1.00 ELSE 0.00 END) AS local,
    CASE WHEN k % 11 = 3 AND k % 4 = 3 THEN 'REVERSAL' WHEN k % 43 = 5 THEN 'OTHER' ELSE op END AS p_op,
    CASE WHEN k % 37 = 4 THEN 'disputed' ELSE status END AS p_status,
    CASE WHEN k % 37 = 4 THEN 'IN_DISPUTE' WHEN status = 'settled' THEN 'PAID' WHEN status = 'pending' THEN 'OPEN'
      ELSE 'REFUSED' END AS state,
    ts + to_days(CASE WHEN k % 41 = 9 THEN 30 ELSE 0 END) AS p_ts
  FROM base WHERE k % 13 <> 5
),
u AS (
  SELECT 'P' || k AS provider_event_id, psp, 'acct_' || n AS provider_account, 'feed_' || (k % 3) || '.csv' AS source_file,
    'R' || k AS psp_reference, CAST(NULL AS VARCHAR) AS parent_psp_reference, 'O' || k AS order_id,
    p_op AS operation_type, state AS source_status, p_status AS status, p_ts AS event_ts, country,
    'sku_' || (k % 7) AS sku, currency, local AS amount_local_signed,
    CASE WHEN k % 23 = 8 THEN CAST(round(local * coalesce(quoted_rate, rate), 2) + 0.01 AS DECIMAL(28,6))
      WHEN k % 29 = 7 THEN CAST(local * quoted_rate AS DECIMAL(28,6)) END AS amount_usd_reported,
    quoted_rate AS fx_rate_reported,
    CASE WHEN p_op <> 'OTHER' THEN state = 'PAID' END AS is_financial_event, k, rate
  FROM feed
)"""

_VALUED = """
rates AS (
  SELECT CASE n_nationkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'BRL' END AS currency,
    DATE '2026-01-01' + CAST(n_nationkey AS INTEGER) AS rate_date,
    CAST(CAST(CASE n_nationkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.1 WHEN 2 THEN 1.3 ELSE 0.2 END AS DECIMAL(6,4))
      * (1 + CAST((24 - n_nationkey) // 4 AS DECIMAL(6,0)) * 0.001) AS DECIMAL(12,8)) AS usd_rate
  FROM nation
),
rated AS (
  SELECT u.*, r.rate_date AS fx_date_selected, r.usd_rate
  FROM u ASOF LEFT JOIN rates r ON u.currency = r.currency AND CAST(u.event_ts AS DATE) >= r.rate_date
),
in_dollars AS (
  SELECT * EXCLUDE (usd_rate), CAST(1 AS DECIMAL(12,8)) AS fx_rate_selected FROM rated WHERE currency = 'USD'
),
in_other_currency AS (
  SELECT * EXCLUDE (usd_rate), CAST(usd_rate AS DECIMAL(12,8)) AS fx_rate_selected FROM rated WHERE currency <> 'USD'
),
p AS (
  SELECT *, coalesce(CAST(amount_usd_reported AS DECIMAL(32,10)), amount_local_signed * fx_rate_selected)
    AS amount_usd_normalized
  FROM (SELECT * FROM in_dollars UNION ALL SELECT * FROM in_other_currency)
)"""

_PAIRS = """
pairs AS (
  SELECT coalesce(e.psp, p.psp) AS psp, e.engine_txn_id, p.provider_event_id,
    CASE WHEN e.engine_txn_id IS NOT NULL AND p.provider_event_id IS NOT NULL THEN 'psp_reference' END AS match_method,
    CASE WHEN p.provider_event_id IS NULL THEN 'engine_only' WHEN e.engine_txn_id IS NULL THEN 'provider_only'
      ELSE 'matched' END AS match_status,
    e.operation_type AS e_op, p.operation_type AS p_op, e.status AS e_status, p.status AS p_status,
    e.currency AS e_ccy, p.currency AS p_ccy, e.fx_date_applied AS e_fx_date, p.fx_date_selected AS p_fx_date,
    e.fx_rate_applied AS e_rate, p.fx_rate_reported AS p_rate_reported, p.fx_rate_selected AS p_rate,
    e.amount_local_signed AS e_local, p.amount_local_signed AS p_local, e.amount_usd_signed AS e_usd,
    p.amount_usd_reported AS p_usd_reported, p.amount_usd_normalized AS p_usd,
    e.event_ts AS e_ts, e.scope_ts AS e_scope, p.event_ts AS p_ts,
    CASE WHEN e.engine_txn_id IS NULL THEN false ELSE e.is_financial_event END AS e_fin,
    CASE WHEN p.provider_event_id IS NULL THEN false ELSE p.is_financial_event END AS p_fin
  FROM e FULL OUTER JOIN p ON e.psp = p.psp AND e.psp_reference = p.psp_reference
)"""


def _scoped(months: str) -> str:
    return f"""
months AS (SELECT unnest([{months}]) AS report_month),
scoped AS (
  SELECT * FROM (
    SELECT m.report_month, pairs.*,
      CASE WHEN engine_txn_id IS NULL THEN false ELSE CAST(date_trunc('month', e_scope) AS DATE) = report_month END
        AS e_in,
      CASE WHEN provider_event_id IS NULL THEN false ELSE CAST(date_trunc('month', p_ts) AS DATE) = report_month END
        AS p_in
    FROM pairs CROSS JOIN months AS m)
  WHERE e_in OR p_in OR e_in IS NULL OR p_in IS NULL
)"""


_JUNE = "DATE '2026-06-01'"
_THREE = "DATE '2026-05-01', DATE '2026-06-01', DATE '2026-07-01'"

# Each side's money and the facts of a link are found on their own; a row's cause is the first in a table of causes.
_DETAIL = """
rows AS (SELECT concat_ws('/', report_month, engine_txn_id, provider_event_id) AS id, * FROM scoped),
engine_money AS (
  SELECT id, CAST(0 AS DECIMAL(28,2)) AS e_rec FROM rows WHERE e_in = false OR e_fin = false
  UNION ALL
  SELECT id, CAST(e_usd AS DECIMAL(28,2)) FROM rows WHERE (e_in = false OR e_fin = false) IS NOT TRUE
),
provider_money AS (
  SELECT id, CAST(0 AS DECIMAL(28,2)) AS p_rec FROM rows WHERE p_in = false OR p_fin = false
  UNION ALL
  SELECT id, CAST(round(p_usd, 2) AS DECIMAL(28,2)) FROM rows WHERE (p_in = false OR p_fin = false) IS NOT TRUE
),
link_facts AS (
  SELECT id, e_op IS DISTINCT FROM p_op AS op_differs, e_status IS DISTINCT FROM p_status AS status_differs,
    e_ccy IS DISTINCT FROM p_ccy AS ccy_differs
  FROM rows WHERE match_status = 'matched'
),
local_facts AS (SELECT id, p_local - e_local AS local_difference FROM rows WHERE e_ccy = p_ccy),
facts AS (
  SELECT rows.*, e_rec, p_rec, p_rec - e_rec AS gap, abs(p_rec - e_rec) AS abs_gap,
    op_differs, status_differs, ccy_differs, local_difference
  FROM rows JOIN engine_money USING (id) JOIN provider_money USING (id)
    LEFT JOIN link_facts USING (id) LEFT JOIN local_facts USING (id)
),
causes(priority, cause) AS (
  VALUES (1, 'unexplained'), (2, 'engine_only'), (3, 'refund_missing_in_engine'), (4, 'reversal_missing_in_engine'),
    (5, 'chargeback_missing_in_engine'), (6, 'provider_only'), (7, 'unexplained'), (8, 'status_lifecycle_difference'),
    (9, 'cutoff_timing'), (10, 'fx_difference'), (11, 'rounding_difference'), (12, 'amount_difference'), (13, 'matched')
),
found AS (
  SELECT id, 1 AS priority FROM facts
  WHERE e_in IS NULL OR p_in IS NULL OR e_fin IS NULL OR p_fin IS NULL OR gap IS NULL
  UNION ALL SELECT id, 2 FROM facts WHERE match_status = 'engine_only'
  UNION ALL SELECT id, 3 FROM facts WHERE match_status = 'provider_only' AND p_op = 'REFUND'
  UNION ALL SELECT id, 4 FROM facts WHERE match_status = 'provider_only' AND p_op = 'REVERSAL'
  UNION ALL SELECT id, 5 FROM facts WHERE match_status = 'provider_only' AND p_op = 'CHARGEBACK'
  UNION ALL SELECT id, 6 FROM facts WHERE match_status = 'provider_only'
  UNION ALL SELECT id, 7 FROM facts WHERE op_differs OR ccy_differs
  UNION ALL SELECT id, 8 FROM facts WHERE status_differs
  UNION ALL SELECT id, 9 FROM facts WHERE e_fin AND p_fin AND e_in <> p_in
  UNION ALL SELECT id, 10 FROM facts
    WHERE gap <> 0 AND local_difference = 0 AND e_rate IS DISTINCT FROM coalesce(p_rate_reported, p_rate)
  UNION ALL SELECT id, 11 FROM facts WHERE gap <> 0 AND local_difference = 0 AND abs_gap <= 0.01
  UNION ALL SELECT id, 12 FROM facts WHERE gap <> 0
  UNION ALL SELECT id, 13 FROM facts
),
first_cause AS (SELECT id, min(priority) AS priority FROM found GROUP BY id),
detail AS (SELECT facts.* EXCLUDE (id), cause FROM facts JOIN first_cause USING (id) JOIN causes USING (priority))"""

_TOTALS = """
totals AS (
  SELECT report_month, psp, cause, count(*) AS row_count,
    CAST(sum(CAST(e_in AS INTEGER)) AS BIGINT) AS engine_record_count,
    CAST(sum(CAST(p_in AS INTEGER)) AS BIGINT) AS provider_record_count,
    CAST(sum(CAST(e_in AND e_fin AS INTEGER)) AS BIGINT) AS engine_financial_count,
    CAST(sum(CAST(p_in AND p_fin AS INTEGER)) AS BIGINT) AS provider_financial_count,
    sum(e_rec) AS engine_amount_usd, sum(p_rec) AS provider_amount_usd, sum(gap) AS signed_usd_impact,
    sum(abs_gap) AS absolute_usd_impact
  FROM detail GROUP BY ALL
)"""

_SIDES = f"{_BASE}, {_ENGINE}, {_PROVIDER}, {_VALUED}, {_PAIRS}"
_JUNE_DETAIL = f"WITH {_SIDES}, {_scoped(_JUNE)}, {_DETAIL}"


def _num(expression: str, alias: str = "", digits: int = 2) -> str:
    return f"CAST(CAST({expression} AS DECIMAL({26 + digits},{digits})) AS DOUBLE) AS {alias or expression}"


def _day(expression: str, alias: str = "") -> str:
    return f"strftime({expression}, '%Y-%m-%d') AS {alias or expression}"


def _ts(expression: str, alias: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {alias}"


def _iso(expression: str, alias: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%SZ') AS {alias}"


_TOTAL_COLUMNS = ", ".join(
    [
        _day("report_month"),
        "psp, cause, row_count, engine_record_count, provider_record_count, engine_financial_count",
        "provider_financial_count",
        *(_num(c) for c in ("engine_amount_usd", "provider_amount_usd", "signed_usd_impact", "absolute_usd_impact")),
    ]
)
_SHARE = "100 * CAST(absolute_usd_impact AS DOUBLE) / nullif(CAST(sum(absolute_usd_impact) OVER (PARTITION BY report_month) AS DOUBLE), 0)"
_SHARE4 = f"CAST({_SHARE} AS DECIMAL(9,4))"

_TARIFFS = """
tariffs AS (
  SELECT 'psp_' || (n_nationkey % 3) AS psp, 'acct_' || n_nationkey AS account,
    DATE '{first}' + CAST(n_regionkey * {region} + j * {step} AS INTEGER) AS valid_from,
    CAST(1 + ((n_nationkey + j) % 7) * 0.25 AS DECIMAL(8,4)) AS percent_fee,
    CAST((j % 2) * 0.30 AS DECIMAL(8,2)) AS fixed_fee,
    CASE WHEN j % 2 = 1 THEN 'USD' END AS fixed_fee_currency
  FROM nation CROSS JOIN (SELECT unnest(range(0, 6)) AS j)
)"""
_FEE_TARIFFS = _TARIFFS.format(first="2026-05-01", region=5, step=12)
_ORDER_TARIFFS = _TARIFFS.format(first="1995-01-01", region=200, step=365)

_FEE_ROWS = """
fee_rows AS (
  SELECT 'psp_' || (n % 3) AS psp, 'P' || k AS provider_event_id, 'acct_' || n AS provider_account,
    CASE WHEN k % 2 = 0 THEN currency ELSE 'USD' END AS fee_currency,
    amount * CASE WHEN k % 2 = 0 THEN CAST(1 AS DECIMAL(6,4)) ELSE rate END AS principal
  FROM base WHERE status = 'settled' AND k % 53 <> 11
),
fee_parts AS (
  SELECT * EXCLUDE (principal), 'commission' AS fee_type, round(principal * 0.01, 2) AS fee_amount FROM fee_rows
  UNION ALL
  SELECT * EXCLUDE (principal), 'markup', round(principal * 0.0175, 2) - round(principal * 0.01, 2) FROM fee_rows
),
reported AS (
  SELECT psp, provider_event_id, provider_account, fee_currency, sum(fee_amount) AS reported FROM fee_parts GROUP BY ALL
)"""

_FEE_SCOPE = """
sales AS (
  SELECT CAST(date_trunc('month', ts) AS DATE) AS report_month, 'psp_' || (n % 3) AS psp, 'P' || k AS provider_event_id,
    'acct_' || n AS provider_account, ts, CAST(ts AS DATE) AS sold_on, currency AS principal_currency, amount AS local,
    CAST(amount * rate AS DECIMAL(28,6)) AS usd, rate
  FROM base WHERE op = 'SALE' AND status = 'settled'
),
contracted AS (
  SELECT sales.* EXCLUDE (sold_on), valid_from, percent_fee, fixed_fee, fixed_fee_currency
  FROM sales ASOF JOIN tariffs ON sales.psp = tariffs.psp AND sales.provider_account = tariffs.account
    AND sales.sold_on >= tariffs.valid_from
)"""

# Sales charged in their own currency, those charged in dollars, and all others, apart.
_FEE_DETAIL = f"""{_FEE_ROWS}, {_FEE_SCOPE},
charged AS (
  SELECT c.*, r.fee_currency, r.reported,
    (fixed_fee = 0 OR fixed_fee_currency IS NOT DISTINCT FROM r.fee_currency) AS payable
  FROM contracted AS c LEFT JOIN reported AS r USING (psp, provider_event_id, provider_account)
),
priced AS (
  SELECT *, rate AS fx, CAST(local AS DECIMAL(24,6)) AS due_on FROM charged WHERE fee_currency = principal_currency
  UNION ALL
  SELECT *, 1, CAST(usd AS DECIMAL(24,6)) FROM charged WHERE fee_currency = 'USD' AND principal_currency <> 'USD'
  UNION ALL
  SELECT *, NULL, NULL FROM charged
  WHERE fee_currency IS NULL OR (fee_currency <> principal_currency AND fee_currency <> 'USD')
),
due AS (
  SELECT *, if(payable, round(due_on * CAST(percent_fee * 0.01 AS DECIMAL(8,6)) + fixed_fee, 2), NULL) AS expected
  FROM priced
),
fee_detail AS (
  SELECT *, reported_usd - expected_usd AS gap_usd FROM (
    SELECT *, reported - expected AS gap, round(reported * fx, 2) AS reported_usd, round(expected * fx, 2) AS expected_usd,
      if(ifnull(reported = expected, false), 'matched', 'fee_difference') AS cause
    FROM due)
)"""
_WITH_FEES = f"WITH {_BASE}, {_FEE_TARIFFS}, {_FEE_DETAIL}"

_FEE_SUMMARY = """
fee_summary AS (
  SELECT report_month, psp, provider_account, fee_currency, cause, count(*) AS event_count,
    sum(reported) AS reported_fee_local, sum(expected) AS expected_fee_local, sum(gap) AS signed_fee_variance_local,
    sum(reported_usd) AS reported_fee_usd, sum(expected_usd) AS expected_fee_usd,
    sum(gap_usd) AS signed_fee_variance_usd, sum(abs(gap_usd)) AS absolute_fee_variance_usd
  FROM fee_detail GROUP BY ALL
)"""
_FEE_SUMS = (
    "reported_fee_local",
    "expected_fee_local",
    "signed_fee_variance_local",
    "reported_fee_usd",
    "expected_fee_usd",
    "signed_fee_variance_usd",
    "absolute_fee_variance_usd",
)
_FEE_SUMMARY_COLUMNS = ", ".join(
    [_day("report_month"), "psp, provider_account, fee_currency, cause, event_count", *(_num(c) for c in _FEE_SUMS)]
)

_PRICE_TEXT = """
text AS (
  SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS t FROM orders
),
written AS (
  SELECT k, CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN '1,' || t ELSE t END AS plain,
    CASE k % 19 WHEN 0 THEN NULL WHEN 1 THEN '-' WHEN 2 THEN '1.' || replace(t, '.', ',')
      ELSE replace(t, '.', ',') END AS comma
  FROM text
)"""

_RATE_FEED = """
feed AS (
  SELECT CAST(ts AS DATE) AS rate_date, 'C' || (user_id % 5) AS currency,
    CAST(1 + CAST(value AS DECIMAL(18,2)) * 0.001 AS DECIMAL(12,6)) AS usd_rate, ts AS published_at, event_id
  FROM events WHERE event_type = 'signup' AND user_id % 5 <> 4
),
quotes AS (
  SELECT * FROM feed
  QUALIFY row_number() OVER (PARTITION BY rate_date, currency ORDER BY published_at DESC, event_id DESC) = 1
),
bought AS (
  SELECT 'V' || event_id AS provider_event_id, CAST(ts AS DATE) AS day,
    CASE WHEN user_id % 5 = 4 THEN 'USD' ELSE 'C' || (user_id % 5) END AS currency,
    CAST(value AS DECIMAL(18,2)) AS local,
    CASE WHEN event_id % 10 = 3 THEN CAST(value AS DECIMAL(18,2)) END AS reported
  FROM events WHERE event_type = 'purchase'
),
rated AS (
  SELECT bought.*, q.rate_date, q.usd_rate FROM bought ASOF LEFT JOIN quotes AS q
    ON bought.currency = q.currency AND bought.day >= q.rate_date
)"""

_CLICKS = """
c AS (SELECT 'E' || event_id AS engine_txn_id, CAST(user_id AS VARCHAR) AS psp, CAST(ts AS DATE) AS day FROM events
  WHERE event_type = 'click'),
v AS (SELECT 'P' || event_id AS provider_event_id, CAST(user_id AS VARCHAR) AS psp, CAST(ts AS DATE) AS day FROM events
  WHERE event_type = 'view'),
cc AS (SELECT *, count(*) OVER (PARTITION BY psp, day) AS rows FROM c),
vv AS (SELECT *, count(*) OVER (PARTITION BY psp, day) AS rows FROM v),
candidates AS (
  SELECT cc.psp, cc.day, engine_txn_id, provider_event_id, cc.rows AS engine_rows, vv.rows AS provider_rows
  FROM cc JOIN vv ON cc.psp = vv.psp AND cc.day = vv.day
)"""

_TWO_RULES = """
SELECT e.psp, engine_txn_id, provider_event_id, 'psp_reference' AS match_method FROM e JOIN u
  ON e.psp = u.psp AND e.psp_reference = u.psp_reference WHERE u.operation_type = 'SALE'{extra}
UNION ALL
SELECT e.psp, engine_txn_id, provider_event_id, 'order_and_operation' FROM e JOIN u
  ON e.psp = u.psp AND e.order_id = u.order_id AND e.operation_type = u.operation_type
  WHERE u.operation_type IN ('REFUND', 'CHARGEBACK'){extra}"""
_EU = f"WITH {_BASE}, {_ENGINE}, {_PROVIDER}"


def _checks(with_clause: str, **counts: str) -> str:
    """One row per check from scalar counting queries."""
    rows = " UNION ALL ".join(
        f"SELECT '{name.replace('__', ':').replace('_dot_', '.')}' AS \"check\", CAST(({sql}) AS BIGINT) AS violations"
        for name, sql in counts.items()
    )
    return f"{with_clause} {rows}"


def _differing(left: str, right: str, keys: str, using: str) -> str:
    """Number of keys that a null-safe full comparison finds on one side only or changed."""
    return f"""SELECT count(*) FROM (SELECT DISTINCT {keys} FROM (
      (SELECT {keys}, {using} FROM {left} EXCEPT SELECT {keys}, {using} FROM {right})
      UNION ALL (SELECT {keys}, {using} FROM {right} EXCEPT SELECT {keys}, {using} FROM {left})))"""


def _excess(left: str, right: str) -> str:
    return f"""SELECT count(*) FROM ((({left}) EXCEPT ALL ({right})) UNION ALL (({right}) EXCEPT ALL ({left})))"""


def _fee_problems(expected: str, events: str) -> str:
    shape = "psp, provider_event_id, provider_account, fee_type, fee_currency, fee_amount"
    return f"""SELECT count(*) FROM (
      SELECT psp, provider_event_id FROM (
        (SELECT {shape} FROM {expected} EXCEPT ALL SELECT {shape} FROM fee_parts)
        UNION ALL (SELECT {shape} FROM fee_parts EXCEPT ALL SELECT {shape} FROM {expected}))
      UNION
      SELECT psp, provider_event_id FROM fee_parts AS f WHERE NOT EXISTS (
        SELECT 1 FROM ({events}) AS x WHERE x.psp = f.psp AND x.provider_event_id = f.provider_event_id))"""


def _source_totals(events: str, detail: str) -> str:
    month = "CAST(date_trunc('month', {ts}) AS DATE) = DATE '2026-06-01'"
    engine_total = "sum(CASE WHEN is_financial_event THEN CAST(amount_usd_signed AS DECIMAL(28,2)) ELSE 0 END)"
    provider_total = "sum(CASE WHEN is_financial_event THEN CAST(round(amount_usd_normalized, 2) AS DECIMAL(28,2)) ELSE 0 END)"
    return f"""SELECT count(*) FROM (
      SELECT psp, 'engine' AS side, count(*) AS n, sum(CAST(is_financial_event AS INTEGER)) AS f, {engine_total} AS usd
        FROM e WHERE {month.format(ts="scope_ts")} GROUP BY psp
      UNION ALL SELECT psp, 'provider', count(*), sum(CAST(is_financial_event AS INTEGER)), {provider_total}
        FROM {events} WHERE {month.format(ts="event_ts")} GROUP BY psp) AS l
      FULL OUTER JOIN (
      SELECT psp, 'engine' AS side, sum(CAST(e_in AS INTEGER)) AS n, sum(CAST(e_in AND e_fin AS INTEGER)) AS f,
        sum(e_rec) AS usd FROM {detail} GROUP BY psp
      UNION ALL SELECT psp, 'provider', sum(CAST(p_in AS INTEGER)), sum(CAST(p_in AND p_fin AS INTEGER)), sum(p_rec)
        FROM {detail} GROUP BY psp) AS d ON l.psp = d.psp AND l.side = d.side
      WHERE d.psp IS NULL OR coalesce(l.n, 0) IS DISTINCT FROM d.n
        OR CASE WHEN l.psp IS NULL THEN 0 ELSE l.f END IS DISTINCT FROM d.f
        OR CASE WHEN l.psp IS NULL THEN 0 ELSE l.usd END IS DISTINCT FROM d.usd"""


_DOCS = "SELECT text, lang, source FROM documents"
_REGROUP = (
    "SELECT report_month, psp, cause, count(*), sum(CAST(e_in AS INTEGER)), sum(CAST(p_in AS INTEGER)), "
    "sum(CAST(e_in AND e_fin AS INTEGER)), sum(CAST(p_in AND p_fin AS INTEGER)), sum(e_rec), sum(p_rec), sum(gap), "
    "sum(abs_gap) FROM {rows} GROUP BY report_month, psp, cause"
)
_FEE_REGROUP_KEYS = "report_month, psp, provider_account, fee_currency, cause"


def _fee_summary_gap(rows: str) -> str:
    """Group keys of the rows by which re-aggregated detail and summary differ, and keys with a NULL part."""
    again = (
        f"SELECT {_FEE_REGROUP_KEYS}, count(*), sum(reported), sum(expected), sum(gap_usd) FROM {rows} "
        f"GROUP BY {_FEE_REGROUP_KEYS}"
    )
    stated = (
        f"SELECT {_FEE_REGROUP_KEYS}, event_count, reported_fee_local, expected_fee_local, signed_fee_variance_usd "
        "FROM fee_summary"
    )
    return f"""SELECT count(*) FROM (SELECT DISTINCT {_FEE_REGROUP_KEYS} FROM (
      ({again} EXCEPT {stated}) UNION ALL ({stated} EXCEPT {again})
      UNION ALL SELECT * FROM ({again} UNION ALL {stated}) AS x
        WHERE len([k FOR k IN [report_month::VARCHAR, psp, provider_account, fee_currency, cause] IF k IS NULL]) > 0))"""


ORACLE: dict[str, str] = {
    # -- staging
    "exact_copies": "SELECT lang, source, length(text) AS n_chars, md5(text) AS text_md5 "
    "FROM (SELECT DISTINCT text, lang, source FROM documents)",
    "copy_conservation": f"""SELECT (SELECT count(*) FROM documents) AS raw_count,
      (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM documents
        GROUP BY text, lang, source)) AS excess_copies,
      (SELECT count(*) FROM (SELECT DISTINCT * FROM ({_DOCS}))) AS staged_count""",
    "typed_copies": """SELECT DISTINCT l_returnflag AS flag, l_linestatus AS line_status,
      CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS quantity,
      CAST(CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS discount FROM lineitem""",
    "minor_units": f"""SELECT k, exponent, {_num("""CASE WHEN digits = 0 THEN CAST(minor AS DECIMAL(28,8))
        WHEN digits BETWEEN 1 AND 8 THEN CAST((minor // power) || '.' || lpad(CAST(minor % power AS VARCHAR),
          CAST(digits AS INTEGER), '0') AS DECIMAL(28,8)) END""", "major", 8)}
      FROM (SELECT *, CAST(pow(10, digits) AS BIGINT) AS power FROM (SELECT *, try_cast(exponent AS SMALLINT) AS digits
        FROM (SELECT o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS minor,
        CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS exponent FROM orders)))""",
    "tolerant_cast": f"WITH {_PRICE_TEXT} SELECT k, {_num('try_cast(plain AS DECIMAL(20,8))', 'amount')} FROM written",
    "decimal_comma_numbers": f"""WITH {_PRICE_TEXT}
      SELECT k, {_num("try_cast(replace(comma, ',', '.') AS DECIMAL(20,8))", "amount")} FROM written""",
    "check_parse_loss": _checks(
        f"WITH {_PRICE_TEXT}",
        plain="SELECT count(*) FROM written WHERE plain IS NOT NULL AND try_cast(plain AS DECIMAL(20,8)) IS NULL",
        comma="SELECT count(*) FROM written WHERE comma IS NOT NULL "
        "AND try_cast(replace(comma, ',', '.') AS DECIMAL(20,8)) IS NULL",
    ),
    "ambiguous_dates": f"""WITH t AS (SELECT o_orderkey AS k,
        CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END
          || ' 10:20:30' AS clock,
        date_trunc('month', o_orderdate) + to_months(CASE WHEN o_orderkey % 19 = 0 THEN 24 ELSE 0 END) AS d FROM orders),
      f AS (SELECT k, clock, 'x_' || strftime(d, '%Y%m%d') || '_' || strftime(last_day(CAST(d AS DATE)), '%Y%m%d')
        || '.csv' AS source_file FROM t),
      g AS (SELECT k, try_strptime(clock, '%d/%m/%Y %H:%M:%S') AS dmy, try_strptime(clock, '%m/%d/%Y %H:%M:%S') AS mdy,
        CAST(try_strptime(regexp_extract(source_file, '_([0-9]{{8}})_([0-9]{{8}})[.]csv$', 1), '%Y%m%d') AS DATE) AS a,
        CAST(try_strptime(regexp_extract(source_file, '_([0-9]{{8}})_([0-9]{{8}})[.]csv$', 2), '%Y%m%d') AS DATE) AS b
        FROM f)
      SELECT k, {_ts("CASE WHEN CAST(dmy AS DATE) BETWEEN a AND b THEN dmy WHEN CAST(mdy AS DATE) BETWEEN a AND b THEN mdy END", "resolved")} FROM g""",
    "local_to_utc": f"""SELECT o_orderkey AS k, {_ts('''(try_strptime(strftime(o_orderdate, '%b %-d, %Y') || ' 0'
        || (4 + o_orderkey % 6) || ':' || (10 + o_orderkey % 50) || ':07', '%b %d, %Y %H:%M:%S')
        AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC\'''', "utc")} FROM orders""",
    "zone_by_row": f"""SELECT k, zone, {_ts('''CASE zone WHEN 'PST' THEN (clock AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC'
        WHEN 'CET' THEN (clock AT TIME ZONE 'Europe/Paris') AT TIME ZONE 'UTC' WHEN 'UTC' THEN clock
        WHEN 'Europe/London' THEN (clock AT TIME ZONE 'Europe/London') AT TIME ZONE 'UTC'
        WHEN 'Asia/Tokyo' THEN (clock AT TIME ZONE 'Asia/Tokyo') AT TIME ZONE 'UTC' END''', "utc")}
      FROM (SELECT o_orderkey AS k, date_trunc('day', o_orderdate) + INTERVAL '15 hours 4 minutes 5 seconds' AS clock,
        CASE o_orderkey % 6 WHEN 0 THEN 'PST' WHEN 1 THEN 'CET' WHEN 2 THEN 'UTC' WHEN 3 THEN 'Europe/London'
        WHEN 4 THEN 'Asia/Tokyo' ELSE 'PDT' END AS zone FROM orders)""",
    "utc_text": f"""SELECT event_id, {_ts("try_strptime(CASE WHEN event_id % 23 = 5 THEN '2024-02-31 00:00:00' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S')", "utc")} FROM events""",
    # -- canonical events
    "canonical_engine": f"""WITH {_BASE}, {_ENGINE} SELECT engine_txn_id, psp, psp_reference, order_id, operation_type,
      status, country, sku, currency, {_day("fx_date_applied")}, {_num("fx_rate_applied", digits=6)},
      {_num("amount_local_signed")}, {_num("amount_usd_signed")}, {_ts("event_ts", "event_timestamp_utc")},
      {_ts("scope_ts", "scope_timestamp_utc")}, is_financial_event FROM e""",
    "canonical_provider": f"""{_EU} SELECT provider_event_id, psp, provider_account, source_file, psp_reference,
      parent_psp_reference, order_id, operation_type, source_status, status, {_ts("event_ts", "event_timestamp_utc")},
      country, sku, currency, {_num("amount_local_signed")}, {_num("amount_usd_reported", digits=6)},
      {_num("fx_rate_reported", digits=6)}, is_financial_event FROM u""",
    "event_ids": """SELECT event_id, concat_ws('|', strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'charge_' || event_type,
        CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END, event_type) AS attribute_id,
      CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END || ':' || lower(event_type) AS lifecycle_id
      FROM events""",
    "financial_flags": f"""{_EU} SELECT operation_type, source_status, status,
      coalesce(CAST(is_financial_event AS VARCHAR), 'unsupported') AS financial, count(*) AS event_count
      FROM u GROUP BY ALL""",
    "signed_amounts": f"""WITH {_BASE}, {_ENGINE} SELECT psp, operation_type, count(*) AS event_count,
      {_num("sum(amount_local_signed)", "amount_local")}, {_num("sum(amount_usd_signed)", "amount_usd")}
      FROM e GROUP BY psp, operation_type""",
    "register_amounts": f"""SELECT l_orderkey, {_num("sum(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END)", "amount")}
      FROM lineitem GROUP BY l_orderkey""",
    "inverted_rates": f"""WITH {_RATE_FEED} SELECT event_id,
      {_num("CAST(CASE WHEN event_id % 11 <> 0 THEN 1 / CAST(usd_rate AS DOUBLE) END AS DECIMAL(18,10))", "inverted", 8)}
      FROM feed""",
    # -- as-of
    "latest_revision": """SELECT user_id, event_type, strftime(day, '%Y-%m-%d') AS day, event_id, value FROM (
      SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
        ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "asof_left": f"""WITH {_RATE_FEED} SELECT provider_event_id, currency, {_day("rate_date")},
      {_num("usd_rate", digits=8)} FROM rated""",
    "usd_valuation": f"""WITH {_RATE_FEED} SELECT provider_event_id, currency, {_day("rate_date", "fx_date_selected")},
      {_num("CASE WHEN currency = 'USD' THEN 1 ELSE usd_rate END", "fx_rate_selected", 8)},
      {_num("coalesce(reported, local * CASE WHEN currency = 'USD' THEN 1 ELSE usd_rate END)", "amount_usd_normalized", 8)}
      FROM rated""",
    "asof_inner": f"""WITH {_ORDER_TARIFFS}, placed AS (SELECT o_orderkey AS k, 'psp_' || (c_nationkey % 3) AS psp,
        'acct_' || c_nationkey AS provider_account, CAST(o_orderdate AS DATE) AS day
        FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT k, placed.psp, provider_account, {_day("valid_from")}, {_num("percent_fee", digits=4)},
        {_num("fixed_fee")}, fixed_fee_currency
      FROM placed ASOF JOIN tariffs ON placed.psp = tariffs.psp AND placed.provider_account = tariffs.account
        AND placed.day >= tariffs.valid_from""",
    # -- matching
    "match_reference": f"""{_EU} SELECT e.psp, engine_txn_id, provider_event_id, 'psp_reference' AS match_method
      FROM e JOIN u ON e.psp = u.psp AND e.psp_reference = u.psp_reference""",
    "match_two_rules": f"{_EU} {_TWO_RULES.format(extra='')}",
    "match_unambiguous": f"""WITH {_CLICKS} SELECT psp, engine_txn_id, provider_event_id, 'user_and_day' AS match_method
      FROM (SELECT *, count(*) OVER (PARTITION BY engine_txn_id) AS a, count(*) OVER (PARTITION BY provider_event_id)
        AS b FROM candidates) WHERE a = 1 AND b = 1""",
    "match_one_sided": f"""WITH {_CLICKS} SELECT psp, engine_txn_id, provider_event_id, 'user_and_day' AS match_method
      FROM candidates WHERE engine_rows = 1 OR provider_rows = 1""",
    "match_repeated_keys": f"""WITH {_CLICKS} SELECT psp, 'user_and_day' AS match_method,
      psp || '|' || strftime(day, '%Y-%m-%d') AS key, count(DISTINCT engine_txn_id) AS engine_rows,
      count(DISTINCT provider_event_id) AS provider_rows, count(*) AS pairs FROM candidates
      WHERE engine_rows > 1 AND provider_rows > 1 GROUP BY psp, day""",
    "match_union": f"""{_EU} SELECT e.psp, engine_txn_id, provider_event_id, 'psp_reference' AS match_method
      FROM e JOIN u ON e.psp = u.psp AND e.psp_reference = u.psp_reference WHERE e.psp = 'psp_0'
      UNION ALL {_TWO_RULES.format(extra=" AND e.psp = 'psp_1'")}
      UNION ALL SELECT psp, engine_txn_id, provider_event_id, 'timestamp_and_attributes' FROM (
        SELECT e.psp, engine_txn_id, provider_event_id, count(*) OVER (PARTITION BY engine_txn_id) AS a,
          count(*) OVER (PARTITION BY provider_event_id) AS b
        FROM e JOIN u ON e.psp = u.psp AND e.event_ts = u.event_ts AND e.operation_type = u.operation_type
          AND e.sku = u.sku AND e.country = u.country AND e.currency = u.currency WHERE e.psp = 'psp_2')
      WHERE a = 1 AND b = 1""",
    # -- payment reconciliation
    "pair_set": f"WITH {_SIDES} SELECT psp, engine_txn_id, provider_event_id, match_method, match_status FROM pairs",
    "period_scope": f"""WITH {_SIDES}, {_scoped(_THREE)} SELECT {_day("report_month")}, engine_txn_id,
      provider_event_id, e_in AS engine_in_period, p_in AS provider_in_period FROM scoped""",
    "recon_detail": f"""{_JUNE_DETAIL} SELECT {_day("report_month")}, psp, engine_txn_id, provider_event_id,
      match_method, match_status, e_op AS engine_operation_type, p_op AS provider_operation_type,
      e_status AS engine_status, p_status AS provider_status, e_ccy AS engine_currency, p_ccy AS provider_currency,
      {_day("e_fx_date", "engine_fx_date")}, {_day("p_fx_date", "provider_fx_date")},
      {_num("e_rate", "engine_fx_rate", 6)}, {_num("p_rate_reported", "provider_fx_rate_reported", 6)},
      {_num("p_rate", "provider_fx_rate", 6)}, {_num("e_local", "engine_amount_local_signed")},
      {_num("p_local", "provider_amount_local_signed")}, {_num("e_usd", "engine_amount_usd_signed")},
      {_num("p_usd_reported", "provider_amount_usd_reported", 6)},
      {_num("p_usd", "provider_amount_usd_normalized", 6)}, {_ts("e_ts", "engine_event_timestamp_utc")},
      {_ts("e_scope", "engine_scope_timestamp_utc")}, {_ts("p_ts", "provider_event_timestamp_utc")},
      e_fin AS engine_is_financial_event, p_fin AS provider_is_financial_event, e_in AS engine_in_period,
      p_in AS provider_in_period, {_num("e_rec", "engine_recognized_usd")}, {_num("p_rec", "provider_recognized_usd")},
      op_differs AS operation_type_differs, status_differs, ccy_differs AS currency_differs,
      {_num("local_difference", "amount_local_difference")}, {_num("p_usd - e_usd", "amount_usd_difference", 6)},
      {_num("gap", "signed_usd_impact")}, {_num("abs_gap", "absolute_usd_impact")}, cause FROM detail""",
    "recon_cause_counts": f"{_JUNE_DETAIL} SELECT cause, count(*) AS row_count FROM detail GROUP BY cause",
    "recon_summary": f"""{_JUNE_DETAIL}, {_TOTALS} SELECT {_TOTAL_COLUMNS},
      provider_record_count - engine_record_count AS record_count_difference,
      provider_financial_count - engine_financial_count AS financial_count_difference,
      {_num(_SHARE4, "absolute_impact_share_pct", 4)} FROM totals""",
    "recon_months": f"""WITH {_SIDES}, {_scoped(_THREE)}, {_DETAIL}, {_TOTALS}
      SELECT {_TOTAL_COLUMNS} FROM totals""",
    "recon_share": f"""{_JUNE_DETAIL}, {_TOTALS} SELECT psp, cause, {_num(_SHARE4, "absolute_impact_share_pct", 4)}
      FROM totals UNION ALL SELECT 'quiet_' || psp, cause, CAST(NULL AS DOUBLE) FROM detail WHERE gap = 0
      GROUP BY psp, cause""",
    "recon_exceptions": f"""{_JUNE_DETAIL} SELECT psp, engine_txn_id, provider_event_id, match_status, cause,
      {_num("gap", "signed_usd_impact")} FROM detail WHERE cause <> 'matched'""",
    "report_payment": f"""{_JUNE_DETAIL} SELECT {_day("report_month")}, psp, engine_txn_id, provider_event_id,
      match_status, cause, e_op AS engine_operation_type, p_op AS provider_operation_type, e_status AS engine_status,
      p_status AS provider_status, {_iso("e_ts", "engine_event_timestamp_utc")},
      {_iso("p_ts", "provider_event_timestamp_utc")}, e_ccy AS engine_currency, p_ccy AS provider_currency,
      {_num("e_local", "engine_amount_local", 8)}, {_num("p_local", "provider_amount_local", 8)},
      {_num("e_usd", "engine_amount_usd")}, {_num("p_usd", "provider_amount_usd")}, {_num("gap", "signed_usd_impact")}
      FROM detail WHERE cause <> 'matched'""",
    "report_payment_summary": f"""{_JUNE_DETAIL}, {_TOTALS} SELECT {_day("report_month")}, psp, cause,
      engine_record_count, provider_record_count,
      provider_record_count - engine_record_count AS record_count_difference, {_num("engine_amount_usd")},
      {_num("provider_amount_usd")}, {_num("signed_usd_impact")}, {_num("absolute_usd_impact")},
      {_num(_SHARE4, "absolute_impact_share_pct", 4)} FROM totals""",
    # -- fees
    "fee_components": f"""SELECT 'P' || l_orderkey AS provider_event_id, fee_type, count(*) AS row_count,
      {_num("sum(fee)", "fee_amount")} FROM (
        SELECT l_orderkey, 'commission' AS fee_type,
          round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS fee FROM lineitem
        UNION ALL SELECT l_orderkey, 'markup',
          round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) FROM lineitem)
      GROUP BY l_orderkey, fee_type""",
    "fee_reported": f"""SELECT 'fees' AS psp, 'acct_0' AS provider_account, 'P' || l_orderkey AS provider_event_id,
      'USD' AS fee_currency,
      {_num("sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) + round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2))", "reported_fee_local")}
      FROM lineitem GROUP BY l_orderkey""",
    "fee_link": """WITH f AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day,
        count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS n FROM events WHERE event_type = 'purchase'),
      c AS (SELECT user_id, CAST(ts AS DATE) AS day, min('C' || event_id) AS id, count(*) AS n FROM events
        WHERE event_type = 'click' GROUP BY ALL)
      SELECT event_id, CASE WHEN f.n = 1 AND c.n = 1 THEN c.id END AS linked
      FROM f LEFT JOIN c ON f.user_id = c.user_id AND f.day = c.day""",
    "fee_expected": f"""WITH {_BASE}, {_FEE_TARIFFS}, {_FEE_SCOPE} SELECT provider_event_id,
      {_day("valid_from", "contract_valid_from")}, {_num("percent_fee", digits=4)},
      {_num("round(CAST(local AS DECIMAL(24,2)) * CAST(percent_fee * 0.01 AS DECIMAL(8,6)) + fixed_fee, 2)", "expected_fee")}
      FROM contracted""",
    "fee_variance": f"""{_WITH_FEES} SELECT {_day("report_month")}, psp, provider_event_id, provider_account,
      fee_currency, principal_currency, {_day("valid_from", "contract_valid_from")}, {_num("percent_fee", digits=4)},
      {_num("fixed_fee")}, {_num("reported", "reported_fee_local")}, {_num("expected", "expected_fee_local")},
      {_num("gap", "signed_fee_variance_local")}, {_num("reported_usd", "reported_fee_usd")},
      {_num("expected_usd", "expected_fee_usd")}, {_num("gap_usd", "signed_fee_variance_usd")},
      {_num("abs(gap_usd)", "absolute_fee_variance_usd")}, cause FROM fee_detail""",
    "fee_summary": f"{_WITH_FEES}, {_FEE_SUMMARY} SELECT {_FEE_SUMMARY_COLUMNS} FROM fee_summary",
    "fee_exceptions": f"""{_WITH_FEES} SELECT provider_event_id, fee_currency,
      {_num("gap_usd", "signed_fee_variance_usd")} FROM fee_detail WHERE cause <> 'matched'""",
    "report_fee": f"""{_WITH_FEES} SELECT {_day("report_month")}, psp, provider_event_id, provider_account,
      {_iso("ts", "event_timestamp_utc")}, fee_currency, {_day("valid_from", "contract_valid_from")},
      {_num("percent_fee", digits=4)}, {_num("fixed_fee")}, fixed_fee_currency,
      {_num("reported", "reported_fee_local")}, {_num("expected", "expected_fee_local")},
      {_num("gap", "signed_fee_variance_local")}, {_num("gap_usd", "signed_fee_variance_usd")}
      FROM fee_detail WHERE cause <> 'matched'""",
    "report_fee_summary": f"{_WITH_FEES}, {_FEE_SUMMARY} SELECT {_FEE_SUMMARY_COLUMNS} FROM fee_summary",
    # -- checks
    "check_columns": _checks(
        _EU,
        not_null__engine_dot_engine_txn_id="SELECT count(*) FROM e WHERE engine_txn_id IS NULL",
        not_null__engine_dot_event_timestamp_utc="SELECT count(*) FROM e WHERE event_ts IS NULL",
        not_null__engine_dot_is_financial_event="SELECT count(*) FROM e WHERE is_financial_event IS NULL",
        accepted_values__engine_dot_operation_type="SELECT count(*) FROM e "
        "WHERE operation_type NOT IN ('SALE', 'REFUND', 'CHARGEBACK')",
        accepted_values__engine_dot_status="SELECT count(*) FROM e WHERE status NOT IN ('settled', 'declined')",
        not_null__provider_dot_provider_event_id="SELECT count(*) FROM u WHERE provider_event_id IS NULL",
        not_null__provider_dot_is_financial_event="SELECT count(*) FROM u WHERE is_financial_event IS NULL",
        not_null__provider_dot_amount_usd_reported="SELECT count(*) FROM u WHERE amount_usd_reported IS NULL",
        accepted_values__provider_dot_operation_type="SELECT count(*) FROM u "
        "WHERE operation_type NOT IN ('SALE', 'REFUND', 'REVERSAL', 'CHARGEBACK')",
    ),
    "check_key": _checks(
        f"WITH {_FEE_TARIFFS}",
        orders="SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
        lines="SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)",
        tariffs="SELECT count(*) FROM (SELECT psp, account, valid_from FROM tariffs GROUP BY ALL HAVING count(*) > 1)",
        undated="SELECT count(*) FROM (SELECT psp, account, d, count(*) AS n FROM (SELECT psp, account, "
        "CASE WHEN fixed_fee = 0 THEN valid_from END AS d FROM tariffs) GROUP BY psp, account, d) WHERE n > 1 OR d IS NULL",
    ),
    "check_conservation": _checks(
        f"""WITH d AS ({_DOCS}), s AS (SELECT DISTINCT * FROM d),
        x AS (SELECT coalesce(sum(n - 1), 0) AS copies FROM (SELECT count(*) AS n FROM d GROUP BY text, lang, source))""",
        copies_removed="SELECT CASE WHEN (SELECT count(*) FROM d) <> (SELECT count(*) FROM s) + (SELECT copies FROM x) "
        "THEN 1 ELSE 0 END",
        rows_missing="SELECT CASE WHEN (SELECT count(*) FROM d) <> (SELECT count(*) FROM s WHERE lang <> 'en') "
        "+ (SELECT copies FROM x) THEN 1 ELSE 0 END",
        all_kept="SELECT CASE WHEN (SELECT count(*) FROM d) <> (SELECT CAST(sum(n) AS BIGINT) FROM "
        "(SELECT count(*) AS n FROM d GROUP BY source)) THEN 1 ELSE 0 END",
        copies_not_kept="SELECT CASE WHEN (SELECT count(*) FROM d) <> (SELECT count(*) FROM s) THEN 1 ELSE 0 END",
    ),
    "check_per_file": _checks(
        f"WITH d AS ({_DOCS}), s AS (SELECT DISTINCT * FROM d)",
        kept="SELECT count(*) FROM (SELECT source, count(*) AS n FROM d GROUP BY 1) AS a "
        "FULL OUTER JOIN (SELECT source, count(*) AS n FROM d GROUP BY 1) AS b USING (source) WHERE a.n <> b.n",
        copies_dropped="SELECT count(*) FROM (SELECT lang, count(*) AS n FROM d GROUP BY 1) AS a "
        "FULL OUTER JOIN (SELECT lang, count(*) AS n FROM s GROUP BY 1) AS b USING (lang) WHERE a.n <> b.n",
    ),
    "check_balance": _checks(
        """WITH l AS (SELECT l_linestatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
          CASE WHEN l_linenumber <> 7 THEN
            -round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) END AS fee,
          round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_tax AS DECIMAL(4,2))), 2) AS net FROM lineitem)""",
        open_lines="SELECT count(*) FROM l WHERE l_linestatus = 'O' AND (gross IS NULL OR fee IS NULL OR net IS NULL "
        "OR gross + fee <> net)",
        gross_is_net="SELECT count(*) FROM l WHERE gross IS NULL OR net IS NULL OR gross <> net",
    ),
    "check_diff": _checks(
        f"""{_EU}, s AS (SELECT 'P' || k AS provider_event_id, currency, local AS amount FROM feed),
        ch AS (SELECT provider_event_id, currency, amount + CASE WHEN currency = 'GBP' THEN 0.01 ELSE 0 END AS amount
          FROM s),
        v AS (SELECT provider_event_id, currency, amount_local_signed AS amount, status FROM u)""",
        same="SELECT count(*) FROM s FULL OUTER JOIN v USING (provider_event_id) "
        "WHERE s.currency IS DISTINCT FROM v.currency OR s.amount IS DISTINCT FROM v.amount",
        changed="SELECT count(*) FROM ch FULL OUTER JOIN v USING (provider_event_id) "
        "WHERE ch.currency IS DISTINCT FROM v.currency OR ch.amount IS DISTINCT FROM v.amount",
        missing="SELECT count(*) FROM s FULL OUTER JOIN (SELECT * FROM v WHERE status <> 'pending') AS w "
        "USING (provider_event_id) WHERE s.currency IS DISTINCT FROM w.currency OR s.amount IS DISTINCT FROM w.amount",
    ),
    "check_fee_source": _checks(
        f"""WITH {_BASE}, {_FEE_ROWS},
        halved AS (SELECT * REPLACE (CASE WHEN fee_type = 'markup' THEN fee_amount * 2 ELSE fee_amount END AS fee_amount)
          FROM fee_parts),
        owners AS (SELECT 'psp_' || (n % 3) AS psp, 'P' || k AS provider_event_id, op FROM base)""",
        same=_fee_problems("fee_parts", "SELECT * FROM owners"),
        changed=_fee_problems("halved", "SELECT * FROM owners"),
        without_event=_fee_problems("fee_parts", "SELECT * FROM owners WHERE op = 'SALE'"),
    ),
    "check_totals": _checks(
        _EU,
        same="""SELECT CASE WHEN (SELECT count(*) FROM base WHERE k % 11 <> 3) <> (SELECT count(*) FROM e) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT sum(if(op = 'SALE', amount, -amount)) FROM base WHERE k % 11 <> 3)
            <> (SELECT sum(amount_local_signed) FROM e) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM base WHERE k % 11 <> 3 AND op = 'SALE')
            <> (SELECT count(*) FROM e WHERE operation_type = 'SALE') THEN 1 ELSE 0 END""",
        different="""SELECT CASE WHEN (SELECT count(*) FROM e) <> (SELECT count(*) FROM u) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT sum(amount_local_signed) FROM e) <> (SELECT sum(amount_local_signed) FROM u) THEN 1 ELSE 0 END
          + CASE WHEN (SELECT count(*) FROM e WHERE operation_type = 'SALE')
            <> (SELECT count(*) FROM u WHERE operation_type = 'SALE') THEN 1 ELSE 0 END""",
        must_not_occur="""SELECT (SELECT CAST(count(*) > 0 AS INTEGER) FROM u WHERE is_financial_event IS NULL)
          + (SELECT CAST(count(*) > 0 AS INTEGER) FROM u WHERE provider_event_id IS NULL)""",
    ),
    "check_cardinality": _checks(
        f"""{_EU}, {_CLICKS},
        r AS (SELECT e.psp, engine_txn_id, provider_event_id FROM e JOIN u
          ON e.psp = u.psp AND e.psp_reference = u.psp_reference),
        loose AS (SELECT * FROM candidates WHERE engine_rows = 1 OR provider_rows = 1),
        twice AS (SELECT psp, provider_event_id FROM v UNION ALL
          SELECT psp, provider_event_id FROM v WHERE day = DATE '2024-01-02')""",
        reference="""SELECT
          (SELECT count(*) FROM (SELECT psp, engine_txn_id FROM r GROUP BY ALL HAVING count(*) > 1))
          + (SELECT count(*) FROM (SELECT psp, provider_event_id FROM r GROUP BY ALL HAVING count(*) > 1))
          + (SELECT count(*) FROM (SELECT psp, provider_event_id FROM u GROUP BY ALL HAVING count(*) > 1))""",
        repeated="""SELECT
          (SELECT count(*) FROM (SELECT psp, engine_txn_id FROM loose GROUP BY ALL HAVING count(*) > 1))
          + (SELECT count(*) FROM (SELECT psp, provider_event_id FROM loose GROUP BY ALL HAVING count(*) > 1))
          + (SELECT count(*) FROM (SELECT psp, provider_event_id FROM twice GROUP BY ALL HAVING count(*) > 1))""",
    ),
    "check_lifecycle": _checks(
        """WITH open AS (SELECT l_orderkey FROM lineitem AS a WHERE l_linestatus = 'O' AND NOT EXISTS (
          SELECT 1 FROM lineitem AS b WHERE b.l_orderkey = a.l_orderkey AND b.l_linestatus = 'F'))""",
        groups="SELECT count(DISTINCT l_orderkey) FROM open",
        open_rows="SELECT count(*) FROM open",
    ),
    "check_match_rederive": _checks(
        f"""{_EU}, two AS ({_TWO_RULES.format(extra='')}),
        r AS (SELECT e.psp, engine_txn_id, provider_event_id, 'psp_reference' AS match_method FROM e JOIN u
          ON e.psp = u.psp AND e.psp_reference = u.psp_reference)""",
        same=_excess(
            "SELECT * FROM two",
            """SELECT e.psp, engine_txn_id, provider_event_id,
              if(u.operation_type = 'SALE', 'psp_reference', 'order_and_operation') FROM e, u
            WHERE e.psp = u.psp AND (u.operation_type = 'SALE' AND e.psp_reference = u.psp_reference
              OR u.operation_type IN ('REFUND', 'CHARGEBACK') AND e.order_id = u.order_id
              AND e.operation_type = u.operation_type)""",
        ),
        other_rule=_excess("SELECT * FROM r", "SELECT * FROM two"),
    ),
    "check_fx_coverage": _checks(
        f"""WITH {_RATE_FEED}""",
        valued="SELECT count(*) FROM rated WHERE currency <> 'USD' AND rate_date IS NULL",
        future_rates="SELECT count(*) FROM rated WHERE (currency <> 'USD' AND rate_date IS NULL) OR rate_date + 3 > day",
    ),
    "check_scope": _checks(
        f"WITH {_BASE}, {_FEE_TARIFFS}, {_FEE_SCOPE}",
        complete="""SELECT abs((SELECT count(*) FROM contracted) - (SELECT count(*) FROM base AS b
          WHERE op = 'SALE' AND status = 'settled' AND EXISTS (SELECT 1 FROM tariffs AS t
            WHERE t.psp = 'psp_' || (b.n % 3) AND t.account = 'acct_' || b.n AND t.valid_from <= CAST(b.ts AS DATE))))""",
        one_month_lost="""SELECT count(*) FROM base AS b WHERE op = 'SALE' AND status = 'settled'
          AND date_trunc('month', ts) = DATE '2026-06-01' AND EXISTS (SELECT 1 FROM tariffs AS t
            WHERE t.psp = 'psp_' || (b.n % 3) AND t.account = 'acct_' || b.n AND t.valid_from <= CAST(b.ts AS DATE))""",
    ),
    "check_summary": _checks(
        f"{_WITH_FEES}, {_FEE_SUMMARY}, fewer AS (SELECT * FROM fee_detail WHERE principal_currency <> 'BRL')",
        same=_fee_summary_gap("fee_detail"),
        rows_lost=_fee_summary_gap("fewer"),
    ),
    "check_multiset": _checks(
        f"{_JUNE_DETAIL}, {_TOTALS}, fewer AS (SELECT * FROM detail WHERE match_status <> 'engine_only')",
        same=_excess(_REGROUP.format(rows="detail"), "SELECT * FROM totals"),
        rows_lost=_excess(_REGROUP.format(rows="fewer"), "SELECT * FROM totals"),
    ),
    "check_three_way": _checks(
        f"""{_JUNE_DETAIL}, moved AS (SELECT * FROM detail WHERE cause <> 'cutoff_timing'),
        decided AS (SELECT * REPLACE (coalesce(is_financial_event, false) AS is_financial_event) FROM p),
        d_fin AS (SELECT * REPLACE (coalesce(p_fin, false) AS p_fin,
          CASE WHEN p_fin IS NULL THEN 0 ELSE p_rec END AS p_rec) FROM detail)""",
        supported=_source_totals("decided", "d_fin"),
        unsupported=_source_totals("p", "detail"),
        rows_lost=_source_totals("p", "moved"),
    ),
}
ORACLE["asof_left_lookup"] = ORACLE["asof_left"]
ORACLE["asof_inner_lookup"] = ORACLE["asof_inner"]

# -- rows that arrive as text, wide numbers, several providers, unclear keys --------

_ARRIVED = """
arrived AS (
  SELECT 'E' || k AS txn_id, op, status, amount, rate, ts FROM base WHERE k % 11 <> 3
  UNION ALL SELECT 'E' || k, op, status, amount, rate, ts FROM base WHERE k % 11 <> 3 AND k % 10 = 0
)"""
_THREE_PROVIDERS = """
offered AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 'unsigned' WHEN 1 THEN 'register' ELSE 'signed' END AS provider,
    if(op = 'SALE', amount, -amount) AS plus_minus FROM base WHERE k % 3 <> 1 OR status <> 'pending'
),
many AS (
  SELECT provider AS psp, op, status AS state, amount,
    CASE provider WHEN 'unsigned' THEN 'U' || k WHEN 'signed' THEN 'S' || k
      ELSE 'R' || k || if(status = 'declined' OR op = 'SALE', ':sale', ':' || lower(op)) END AS provider_event_id,
    CASE WHEN provider = 'unsigned' THEN if(op = 'CHARGEBACK', 'OTHER', op)
      WHEN provider = 'signed' THEN replace(op, 'CHARGEBACK', 'REVERSAL')
      WHEN status = 'declined' THEN 'SALE' ELSE op END AS operation_type,
    if(provider = 'signed' AND status = 'pending', 'unknown', status) AS status,
    CASE WHEN provider = 'unsigned' AND op = 'CHARGEBACK' THEN amount ELSE plus_minus END AS amount_local_signed,
    if(provider <> 'signed' AND currency = 'USD',
      CASE WHEN provider = 'unsigned' AND op = 'CHARGEBACK' THEN amount ELSE plus_minus END, NULL) AS amount_usd_reported,
    if(provider = 'signed' AND op <> 'SALE', 'R' || (k - 3), NULL) AS parent_psp_reference,
    CASE WHEN provider = 'register' THEN status = 'settled'
      WHEN provider = 'signed' THEN if(status = 'settled', true, NULL)
      WHEN op = 'CHARGEBACK' OR status = 'pending' OR (op = 'REFUND' AND status = 'declined') THEN NULL
      ELSE status = 'settled' END AS is_financial_event
  FROM offered
)"""
_MANY = f"WITH {_BASE}, {_THREE_PROVIDERS}"
_TOTAL_FEES = """
totals_charged AS (
  SELECT 'signed' AS psp, 'S' || k AS provider_event_id, 'total' AS fee_type, currency, round(amount * 0.029, 2) AS fee
  FROM base WHERE k % 3 = 2 AND op = 'SALE'
)"""

ORACLE |= {
    "keep_all_rows": f"""WITH {_BASE}, {_ARRIVED} SELECT op AS operation_type, status, count(*) AS row_count,
      count(DISTINCT txn_id) AS transactions FROM arrived GROUP BY ALL""",
    "strict_types": f"""WITH {_BASE}, {_ARRIVED} SELECT DISTINCT txn_id, {_num("amount", "amount_local", 8)},
      {_num("rate", "fx_rate_applied", 6)}, {_day("ts", "fx_date_applied")},
      {_num("round(amount * rate, 2)", "amount_usd", 8)} FROM arrived""",
    "zoned_times": f"""WITH {_BASE}, {_ARRIVED} SELECT DISTINCT txn_id,
      {_ts("ts - INTERVAL 3 HOUR", "created_at_utc")},
      {_ts("CASE status WHEN 'settled' THEN ts - INTERVAL 2 HOUR END", "captured_at_utc")} FROM arrived""",
    "convert_wide": """SELECT o_orderkey AS k, CAST(CAST(CAST(o_orderkey % 1000 AS DECIMAL(11,8)) + 0.12345678 AS DECIMAL(12,8))
        * CAST(CAST(o_totalprice AS DECIMAL(18,2)) * if(o_orderkey % 2 = 0, 100.00, 0.01) + 0.0000000003 AS DECIMAL(18,10))
      AS VARCHAR) AS value FROM orders""",
    "fee_expected_wide": """SELECT o_orderkey AS k, CAST(CAST(round(CAST(CAST(o_totalprice AS DECIMAL(19,2))
        * if(o_orderkey % 2 = 0, CAST(2000000.00000001 AS DECIMAL(15,8)), CAST(0.50000001 AS DECIMAL(15,8)))
        AS DECIMAL(24,10)) * CAST((2.1234567891 + o_orderkey % 7) * 0.01 AS DECIMAL(13,12)) + 0.3, 2)
      AS DECIMAL(20,2)) AS VARCHAR) AS fee FROM orders""",
    "reported_usd": f"""{_MANY} SELECT psp, provider_event_id, operation_type, {_num("amount_local_signed")},
      {_num("amount_usd_reported")} FROM many""",
    "final_states": f"""{_MANY} SELECT CASE WHEN status = 'declined' THEN 'Refused' WHEN op = 'SALE' THEN 'Settled'
        WHEN op = 'REFUND' THEN 'Refunded' ELSE 'Chargeback' END AS source_status, operation_type, status,
      count(*) AS event_count FROM many WHERE psp = 'register' GROUP BY ALL""",
    "parent_references": f"{_MANY} SELECT psp, provider_event_id, parent_psp_reference FROM many",
    "event_union": f"""{_MANY} SELECT psp, operation_type, status,
      ifnull(CAST(is_financial_event AS VARCHAR), 'unsupported') AS financial, count(*) AS event_count,
      {_num("sum(amount_local_signed)", "amount")} FROM many GROUP BY ALL""",
    "total_fees": f"""WITH {_BASE}, {_TOTAL_FEES} SELECT psp, provider_event_id, fee_type, currency,
      {_num("fee", "fee_amount")} FROM totals_charged""",
    "fee_union": f"""WITH {_BASE}, {_FEE_ROWS}, {_TOTAL_FEES} SELECT psp, fee_type, currency, count(*) AS row_count,
      {_num("sum(fee)", "fee_amount")} FROM (SELECT psp, fee_type, currency, fee FROM totals_charged
        UNION ALL SELECT psp, fee_type, fee_currency, fee_amount FROM fee_parts) GROUP BY psp, fee_type, currency""",
    "asof_null_dates": f"""WITH {_BASE}, {_ENGINE}, {_PROVIDER}, {_VALUED},
      q AS (SELECT if(day(rate_date) = 7, NULL, currency) AS currency, if(day(rate_date) % 5 = 0, NULL,
        if(day(rate_date) % 3 = 0, rate_date - 1, rate_date)) AS rate_date, usd_rate FROM rates),
      best AS (SELECT currency, rate_date, max(usd_rate) AS usd_rate FROM q
        WHERE currency IS NOT NULL AND rate_date IS NOT NULL GROUP BY ALL),
      sold AS (SELECT k, if(k % 13 = 0, NULL, currency) AS paid_in,
        if(k % 17 = 0, NULL, DATE '2025-12-28' + CAST(k % 40 AS INTEGER)) AS day FROM base)
      SELECT k, {_day("rate_date")}, {_num("usd_rate", digits=8)} FROM sold LEFT JOIN LATERAL (
        SELECT rate_date, usd_rate FROM best WHERE best.currency = sold.paid_in AND best.rate_date <= sold.day
        ORDER BY rate_date DESC LIMIT 1) ON true""",
    "match_repeated_both": f"""WITH {_CLICKS}, unclear AS (
        SELECT psp, day FROM candidates GROUP BY ALL
        HAVING count(DISTINCT engine_txn_id) > 1 AND count(DISTINCT provider_event_id) > 1)
      SELECT psp, 'E' AS side, engine_txn_id AS id FROM c SEMI JOIN unclear USING (psp, day)
      UNION ALL SELECT psp, 'P', provider_event_id FROM v SEMI JOIN unclear USING (psp, day)""",
    "match_shared_ids": f"""WITH {_CLICKS}, pairs AS (
        SELECT psp, 'E' || (CAST(substr(engine_txn_id, 2) AS BIGINT) // 40) AS engine_txn_id, provider_event_id
        FROM candidates WHERE engine_rows = 1 AND provider_rows = 1)
      SELECT psp, engine_txn_id, provider_event_id, 'user_and_day' AS match_method FROM pairs
      QUALIFY count(*) OVER (PARTITION BY psp, engine_txn_id) = 1
        AND count(*) OVER (PARTITION BY psp, provider_event_id) = 1""",
    "recon_ambiguous": f"""{_JUNE_DETAIL.replace("e.psp_reference = p.psp_reference", "e.psp_reference = p.psp_reference AND e.psp_reference NOT LIKE '%7'")}
      SELECT psp, match_status, CASE WHEN coalesce(engine_txn_id, provider_event_id) LIKE '%7' THEN 'unexplained'
        ELSE cause END AS cause, count(*) AS row_count FROM detail GROUP BY ALL""",
}
