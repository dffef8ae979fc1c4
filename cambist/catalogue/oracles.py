"""The same results in ANSI SQL, on the same tables.

Divisions are done on whole cents: the other engine divides decimals as doubles.
"""

from __future__ import annotations

PAYMENTS = """
payments AS (
  SELECT o_orderkey AS payment_id, o_orderkey % 10 AS merchant_id, o_custkey AS shopper_id,
         CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CAST(round(o_totalprice * 100) AS HUGEINT) AS cents,
         CASE c_nationkey % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF'
              WHEN 4 THEN 'CAD' WHEN 5 THEN 'AUD' ELSE 'XYZ' END AS currency,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'card' WHEN '2' THEN 'paypal' WHEN '3' THEN 'apple_pay'
              WHEN '4' THEN 'bank_transfer' ELSE 'google_pay' END AS payment_method,
         CASE o_orderkey % 8 WHEN 0 THEN 'authorized' WHEN 1 THEN 'failed' WHEN 2 THEN 'captured' WHEN 3 THEN 'pending'
              WHEN 4 THEN 'refunded' WHEN 5 THEN 'authorized' WHEN 6 THEN 'chargeback' ELSE 'cancelled' END AS payment_status,
         CASE c_nationkey % 5 WHEN 0 THEN 'NL' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'GB' ELSE 'CH' END AS country_code,
         CAST(o_orderdate AS TIMESTAMP) AS created_at, CAST(o_orderdate AS DATE) AS payment_date
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

RATES = """
feed_days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS rate_date,
         date_diff('day', DATE '1995-01-02', CAST(o_orderdate AS DATE)) AS n FROM orders
),
bases AS (SELECT * FROM (VALUES ('EUR', 900), ('GBP', 770), ('CHF', 880), ('CAD', 1300), ('AUD', 1450)) AS b(currency, mills)),
rates AS (
  SELECT rate_date, 'USD' AS base_currency, currency,
         CAST(mills + n % 50 AS HUGEINT) * 100000 AS rate_e8,
         CAST(CAST(mills + n % 50 AS DECIMAL(18,3)) * 0.001 AS DECIMAL(18,8)) AS rate
  FROM feed_days, bases
  WHERE n % 7 < 5 AND (currency <> 'CAD' OR rate_date >= DATE '1996-01-01')
)"""

_LOOKED_UP = """
looked_up AS (
  SELECT p.*, CASE WHEN p.currency = 'USD' THEN CAST(1 AS DECIMAL(18,8)) ELSE r.rate END AS rate,
         CASE WHEN p.currency = 'USD' THEN 100000000 ELSE r.rate_e8 END AS rate_e8,
         CASE WHEN p.currency <> 'USD' THEN r.rate_date END AS published_on
  FROM payments p ASOF LEFT JOIN rates r ON p.currency = r.currency AND p.payment_date >= r.rate_date
)"""

_FACT = """
fact AS (
  SELECT payment_id, merchant_id, shopper_id, payment_date, created_at, currency, amount, payment_method,
         payment_status, country_code, rate AS fx_rate,
         CASE WHEN currency = 'USD' THEN CAST(amount AS DECIMAL(18,2))
              ELSE CAST(CAST((2 * cents * 100000000 + rate_e8) // (2 * rate_e8) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))
         END AS amount_usd,
         published_on IS NOT NULL AND published_on <> payment_date AS fx_rate_carried_forward,
         payment_status IN ('authorized', 'captured') AS is_revenue,
         rate IS NULL AS is_unconverted
  FROM looked_up
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_LOOKUP = _with(PAYMENTS, RATES, _LOOKED_UP)
_FACTS = _with(PAYMENTS, RATES, _LOOKED_UP, _FACT)

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, CAST(ts AS TIMESTAMP) AS ts, epoch_us(CAST(ts AS TIMESTAMP)) AS us,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE event_type WHEN 'error' THEN -1 ELSE 1 END * CAST(round(value * 100) AS BIGINT) AS cents,
         CASE user_id % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF'
              WHEN 4 THEN 'CAD' WHEN 5 THEN 'AUD' ELSE 'XYZ' END AS currency,
         CASE user_id % 5 WHEN 0 THEN 'card' WHEN 1 THEN 'paypal' WHEN 2 THEN 'apple_pay'
              WHEN 3 THEN 'bank_transfer' ELSE 'google_pay' END AS payment_method,
         CASE event_type WHEN 'signup' THEN 'authorized' WHEN 'view' THEN 'captured' WHEN 'click' THEN 'pending'
              WHEN 'purchase' THEN 'refunded' ELSE 'failed' END AS payment_status,
         CASE user_id % 5 WHEN 0 THEN 'NL' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'GB' ELSE 'CH' END AS country_code
  FROM events
)"""

_DECODED = """
read AS (
  SELECT *, k IN (0, 4) AS is_tombstone, k IN (0, 1, 2, 4, 5, 6, 19, 20) AS no_row, k IN (0, 1, 2, 4, 5, 19, 20) AS no_op,
         k IN (0, 1, 2, 4, 5, 10, 19, 20) AS no_source FROM ev
),
decoded AS (
  SELECT 'cdc.public.payments' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         CASE WHEN NOT no_row AND k <> 3 THEN user_id END AS payment_id,
         CASE WHEN NOT no_row THEN user_id % 10 END AS merchant_id,
         CASE WHEN NOT no_row THEN user_id + 500 END AS shopper_id,
         CASE WHEN NOT no_row AND k NOT IN (14, 18)
              THEN CAST(CAST(cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) END AS amount,
         CASE WHEN NOT no_row THEN currency END AS currency,
         CASE WHEN NOT no_row THEN payment_method END AS payment_method,
         CASE WHEN NOT no_row THEN payment_status END AS payment_status,
         CASE WHEN NOT no_row THEN country_code END AS country_code,
         CASE WHEN NOT no_row AND k <> 15 THEN ts END AS created_at,
         CASE WHEN NOT no_row THEN ts END AS updated_at,
         CASE WHEN no_op THEN NULL WHEN k = 6 THEN 't' ELSE op END AS cdc_op,
         CASE WHEN no_source THEN '' ELSE 'payments' END AS cdc_table,
         CASE WHEN NOT no_source AND k <> 9 THEN event_id END AS cdc_lsn,
         CASE WHEN NOT no_source THEN date_trunc('millisecond', ts) END AS cdc_source_ts,
         NOT no_op AND k <> 6 AND op <> 'd' AS is_upsert,
         NOT no_op AND k <> 6 AND op = 'd' AS is_deleted,
         is_tombstone,
         NOT no_row AND NOT no_op AND k <> 3 AS decode_ok,
         CASE k WHEN 1 THEN 'not_an_envelope' WHEN 5 THEN 'not_an_envelope' WHEN 19 THEN 'not_an_envelope'
                WHEN 20 THEN 'not_an_envelope' WHEN 2 THEN 'unknown_operation'
                WHEN 6 THEN 'truncate' WHEN 3 THEN 'missing_key' END AS reason,
         ts AS kafka_timestamp
  FROM read
)"""

_ORDER = """coalesce(cdc_lsn, -1) DESC, coalesce(epoch_ms(cdc_source_ts), -1) DESC, "partition" DESC, "offset" DESC"""

_SILVER = (
    "payment_id, merchant_id, shopper_id, amount, currency, payment_method, payment_status, country_code,"
    " created_at, updated_at, cdc_lsn, cdc_source_ts"
)


def _latest(name: str, condition: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (position) FROM (
    SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY {_ORDER}) AS position
    FROM decoded WHERE decode_ok AND {condition}
  ) WHERE position = 1
)"""


_CHANGES = _with(EVENTS, _DECODED)
_LATEST = _with(EVENTS, _DECODED, _latest("latest"))
_CURRENT = f"{_LATEST} SELECT {_SILVER} FROM latest WHERE NOT is_deleted"

_GOLD_REVENUE = """
gold AS (
  SELECT CAST(created_at AS DATE) AS revenue_date, merchant_id, currency, count(*) AS payment_count,
         sum(cents) AS sum_cents, count(DISTINCT shopper_id) AS distinct_shoppers, count(cents) AS n
  FROM {source} WHERE payment_status IN ('authorized', 'captured') GROUP BY 1, 2, 3
),
revenue AS (
  SELECT revenue_date, merchant_id, currency, payment_count,
         CAST(CAST(sum_cents AS DECIMAL(22,0)) * 0.01 AS DECIMAL(22,2)) AS gross_amount,
         CAST(CAST(CASE WHEN sum_cents >= 0 THEN (2 * sum_cents + n) // (2 * n)
                        ELSE -((-2 * sum_cents + n) // (2 * n)) END AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2)) AS average_amount,
         distinct_shoppers
  FROM gold
)"""

_REVENUE = _with(PAYMENTS, _GOLD_REVENUE.format(source="payments"))

_MIX = _with(
    PAYMENTS,
    """
counted AS (
  SELECT CAST(created_at AS DATE) AS activity_date, country_code, payment_method, count(*) AS payment_count
  FROM payments GROUP BY 1, 2, 3
),
mix AS (
  SELECT *, round(100 * payment_count / sum(payment_count) OVER (PARTITION BY activity_date, country_code), 2) AS share_pct
  FROM counted
)""",
)

_DAILY = """
spine AS (SELECT payment_date AS calendar_date FROM payments UNION SELECT rate_date FROM rates),
traded AS (SELECT DISTINCT currency FROM payments WHERE currency <> 'USD'),
daily AS (
  SELECT calendar_date, currency, published_rate,
         last_value(published_rate IGNORE NULLS) OVER (
           PARTITION BY currency ORDER BY calendar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS effective_rate
  FROM (SELECT s.calendar_date, t.currency, r.rate AS published_rate
        FROM spine s CROSS JOIN traded t
        LEFT JOIN rates r ON r.rate_date = s.calendar_date AND r.currency = t.currency)
)"""

_MISSING = """
calendar AS (
  SELECT CAST(unnest(generate_series(CAST(min(rate_date) AS TIMESTAMP), CAST(max(rate_date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
         AS missing_date FROM rates),
missing AS (
  SELECT w.currency, c.missing_date FROM {wanted} w CROSS JOIN calendar c
  WHERE NOT EXISTS (SELECT 1 FROM rates r WHERE r.currency = w.currency AND r.rate_date = c.missing_date)
),
runs AS (
  SELECT currency, min(missing_date) AS gap_start, max(missing_date) AS gap_end, count(*) AS gap_days
  FROM (SELECT *, missing_date - CAST(row_number() OVER (PARTITION BY currency ORDER BY missing_date) AS INTEGER) AS island
        FROM missing) GROUP BY currency, island
)"""

_DAILY_REVENUE = """
  SELECT payment_date AS revenue_date, merchant_id, count(*) AS payment_count,
         count(*) FILTER (WHERE is_revenue) AS settled_count,
         CAST(coalesce(sum(amount_usd) FILTER (WHERE is_revenue AND NOT is_unconverted), 0) AS DECIMAL(28,2)) AS gross_amount_usd,
         count(*) FILTER (WHERE is_revenue AND is_unconverted) AS unconverted_count,
         count(DISTINCT shopper_id) AS distinct_shoppers,
         count(*) FILTER (WHERE fx_rate_carried_forward) AS carried_forward_count
  FROM fact GROUP BY 1, 2"""

_MERCHANTS = """
merchants AS (
  SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
         CASE s_nationkey % 5 WHEN 0 THEN 'NL' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'GB' ELSE 'CH' END AS country_code,
         CASE s_suppkey % 5 WHEN 0 THEN 'fashion' WHEN 1 THEN 'travel' WHEN 2 THEN 'grocery'
              WHEN 3 THEN 'health' ELSE 'home' END AS category
  FROM supplier
)"""

_CLAUSES = _with(
    EVENTS, _DECODED, _latest("first_half", "hour(kafka_timestamp) < 12"),
    _latest("second_half", "hour(kafka_timestamp) >= 12"),
    "target AS (SELECT * FROM first_half WHERE NOT is_deleted)",
)

_REPORT_RANGE = "merchant_id = 3 AND revenue_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"


def _count(model: str, check: str, source: str) -> str:
    return f"SELECT '{model}' AS model, '{check}' AS check_name, ({source}) AS violations"


def _violations() -> str:
    damaged = """
hurt_once AS (
  SELECT * REPLACE (CASE WHEN payment_status <> 'cancelled' THEN amount END AS amount,
                    CASE WHEN payment_status = 'pending' THEN 'held' ELSE payment_status END AS payment_status)
  FROM fact
),
hurt AS (SELECT * FROM hurt_once UNION ALL SELECT * FROM hurt_once WHERE payment_method = 'google_pay'),
hurt_staged AS (
  SELECT * REPLACE (CASE WHEN payment_id % 499 <> 0 THEN payment_id END AS payment_id, CASE WHEN payment_id % 503 <> 0 THEN currency END AS currency,
                    CASE WHEN payment_id % 509 <> 0 THEN payment_date END AS payment_date) FROM hurt
),
hurt_fact AS (SELECT * REPLACE (CASE WHEN payment_id % 487 <> 0 THEN payment_id END AS payment_id) FROM hurt),
doubled_feed AS (SELECT * FROM rates UNION ALL SELECT * FROM rates WHERE currency = 'CHF'),
hurt_feed AS (
  SELECT * REPLACE (CASE WHEN currency <> 'EUR' OR day(rate_date) <> 13 THEN rate END AS rate,
                    CASE WHEN currency <> 'GBP' OR day(rate_date) <> 14 THEN rate_date END AS rate_date,
                    CASE WHEN currency <> 'CAD' OR day(rate_date) <> 15 THEN currency END AS currency) FROM doubled_feed
),
hurt_merchants AS (
  SELECT CASE WHEN merchant_id % 7 <> 0 THEN merchant_id END AS merchant_id
  FROM (SELECT * FROM merchants UNION ALL SELECT * FROM merchants WHERE merchant_id % 5 = 0)
),
hurt_daily AS (SELECT payment_date, merchant_id, count(*) AS payments FROM hurt GROUP BY 1, 2)"""
    rows = [
        *[_count("stg_payments", f"not_null_{c}", f"SELECT count(*) FROM hurt_staged WHERE {c} IS NULL")
          for c in ("payment_id", "amount", "currency", "payment_date")],
        _count("stg_payments", "unique_payment_id",
               "SELECT count(*) FROM (SELECT payment_id FROM hurt_staged WHERE payment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
        *[_count("stg_fx_rates", f"not_null_{c}", f"SELECT count(*) FROM hurt_feed WHERE {c} IS NULL")
          for c in ("rate", "rate_date", "currency")],
        _count("stg_fx_rates", "unique_rate_date_currency",
               "SELECT count(*) FROM (SELECT 1 FROM hurt_feed WHERE rate_date IS NOT NULL AND currency IS NOT NULL"
               " GROUP BY rate_date, currency HAVING count(*) > 1)"),
        *[row for m in ("stg_merchants", "dim_merchants") for row in (
            _count(m, "not_null_merchant_id", "SELECT count(*) FROM hurt_merchants WHERE merchant_id IS NULL"),
            _count(m, "unique_merchant_id",
                   "SELECT count(*) FROM (SELECT 1 FROM hurt_merchants WHERE merchant_id IS NOT NULL GROUP BY merchant_id HAVING count(*) > 1)"))],
        _count("fx_rates_daily", "carried_forward_implies_a_rate_exists",
               "SELECT count(*) FROM daily WHERE currency = 'GBP' AND published_rate IS NULL AND effective_rate IS NOT NULL"),
        _count("fct_payments_usd", "not_null_payment_id", "SELECT count(*) FROM hurt_fact WHERE payment_id IS NULL"),
        _count("fct_payments_usd", "accepted_values_payment_status",
               "SELECT count(*) FROM hurt WHERE payment_status = 'held'"),
        _count("fct_payments_usd", "no_negative_converted_amounts",
               "SELECT count(*) FROM hurt WHERE amount > 0 AND (CASE WHEN payment_id % 101 = 0 THEN -amount_usd ELSE amount_usd END) < 0"),
        _count("fct_payments_usd", "usd_payments_convert_one_to_one",
               "SELECT count(*) FROM hurt WHERE currency = 'USD' AND (fx_rate <> 1 OR"
               " (CASE WHEN payment_id % 101 = 0 THEN -amount_usd ELSE amount_usd END) <> amount)"),
        _count("fct_payments_usd", "unique_payment_id",
               "SELECT count(*) FROM (SELECT payment_id FROM hurt_fact WHERE payment_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"),
        *[_count("fct_daily_revenue_usd", c, f"SELECT count(*) FROM hurt_daily WHERE merchant_id = {m}") for c, m in (
            ("not_null_revenue_date", 9), ("not_null_merchant_id", 7), ("not_null_gross_amount_usd", 5),
            ("revenue_never_exceeds_total_payments", 3))],
    ]
    return _with(PAYMENTS, RATES, _LOOKED_UP, _FACT, _MERCHANTS, _DAILY, damaged) + " " + " UNION ALL ".join(rows)


_GOLD_OF_CHANGES = (
    _with(
        EVENTS, _DECODED, _latest("latest"),
        "live AS (SELECT *, CAST(amount * 100 AS HUGEINT) AS cents FROM latest WHERE NOT is_deleted)",
        _GOLD_REVENUE.format(source="live"),
    )
    + " SELECT * FROM revenue"
)

_REFRESHED_CHECKS = (
    _with(PAYMENTS)
    + """,
hurt AS (SELECT payment_id, CASE WHEN payment_status = 'pending' THEN 'held' ELSE payment_status END AS status FROM payments WHERE payment_date < DATE '2000-01-01'),
standing AS (
  SELECT * FROM hurt
  UNION ALL SELECT h.* FROM hurt h JOIN payments p USING (payment_id) WHERE p.payment_method = 'google_pay'
  UNION ALL SELECT payment_id, payment_status FROM payments WHERE payment_date >= DATE '2000-01-01'
  UNION ALL SELECT payment_id, payment_status FROM payments
  WHERE payment_id % 50 = 0 AND payment_date BETWEEN DATE '1999-12-01' AND DATE '1999-12-31'
)
SELECT 'fct_payments_usd' AS model, check_name, violations FROM (
  SELECT 'not_null_payment_id' AS check_name, CAST(0 AS BIGINT) AS violations
  UNION ALL SELECT 'accepted_values_payment_status', (SELECT count(*) FROM standing WHERE status = 'held')
  UNION ALL SELECT 'no_negative_converted_amounts', 0
  UNION ALL SELECT 'usd_payments_convert_one_to_one', 0
  UNION ALL SELECT 'unique_payment_id', (SELECT count(*) FROM (SELECT payment_id FROM standing GROUP BY 1 HAVING count(*) > 1)))"""
)

_HEALTH = (
    _with(EVENTS, _DECODED, PAYMENTS, RATES, _LOOKED_UP, _FACT, _MISSING.format(wanted="(SELECT DISTINCT currency FROM rates)"))
    + """,
counts AS (
  SELECT 'unconverted' AS metric, (SELECT count(*) FROM fact WHERE is_unconverted) AS value
  UNION ALL SELECT 'carried_forward', (SELECT count(*) FROM fact WHERE fx_rate_carried_forward)
  UNION ALL SELECT 'quarantined', (SELECT count(*) FROM decoded WHERE reason IS NOT NULL)
  UNION ALL SELECT 'batches_not_reconciled', (
    SELECT count(*) FROM (SELECT count(*) AS m, count(*) FILTER (decode_ok) AS d, count(*) FILTER (reason IS NOT NULL) AS q,
                                 count(*) FILTER (is_tombstone) AS t FROM decoded GROUP BY topic) WHERE m <> d + q + t)
  UNION ALL SELECT 'longest_rate_gap_days', (SELECT max(gap_days) FROM runs)
)
SELECT metric, value, CASE metric WHEN 'carried_forward' THEN TRUE WHEN 'longest_rate_gap_days' THEN value <= 2
                                  ELSE value = 0 END AS healthy FROM counts"""
)

_FORMS = " UNION ALL ".join(
    f"SELECT event_id, '{form}' AS form, {amount} AS amount FROM ev"
    for form, amount in [
        *[(f, "CAST(CAST(cents AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2))")
          for f in ("base64_minimal", "base64_8_bytes", "base64_16_bytes", "digits", "whole_cents", "number")],
        *[(f, "CAST(NULL AS DECIMAL(12,2))") for f in ("null", "empty", "no_padding", "object")],
    ]
)

_WIDE_FORMS = " UNION ALL ".join(
    f"""SELECT event_id, '{form}_{digits}' AS form,
        CAST(CASE WHEN cents < 0 THEN '-' ELSE '' END || w[:-5] || '.' || w[-4:] AS DECIMAL(38,4)) AS amount
    FROM (SELECT event_id, cents, CAST(CAST('1{"0" * (digits - 1)}' AS HUGEINT) + abs(cents) AS VARCHAR) AS w FROM ev)"""
    for digits in (17, 18, 19, 20, 25, 31, 38)
    for form in ("base64", "whole", "digits")
)

_INCREMENTAL = (
    _with(PAYMENTS, RATES, _LOOKED_UP, _FACT)
    + """,
raised AS (
  SELECT rate_date, base_currency, currency,
         rate_e8 + CASE WHEN year(rate_date) >= 2000 THEN 1000000 ELSE 0 END AS rate_e8,
         CAST(rate + CASE WHEN year(rate_date) >= 2000 THEN 0.01 ELSE 0 END AS DECIMAL(18,8)) AS rate
  FROM rates
),
"""
    + _LOOKED_UP.replace("looked_up AS", "looked_up_2 AS").replace("JOIN rates r", "JOIN raised r")
    + ","
    + _FACT.replace("fact AS", "fact_2 AS").replace("FROM looked_up", "FROM looked_up_2")
    + """,
loaded AS (SELECT * FROM fact WHERE payment_date <= DATE '2000-12-31'),
start AS (SELECT max(payment_date) - 7 AS start_date FROM loaded)
SELECT * FROM fact_2 WHERE payment_date >= (SELECT start_date FROM start)
UNION ALL
SELECT * FROM loaded WHERE payment_date < (SELECT start_date FROM start)"""
)



def _fact_of(name: str, payments: str, rates: str) -> str:
    """The fact over other payments and rates, as a further common table."""
    looked_up = _LOOKED_UP.replace("looked_up AS", f"looked_up_{name} AS").replace("FROM payments p", f"FROM {payments} p")
    looked_up = looked_up.replace("JOIN rates r", f"JOIN {rates} r")
    return looked_up + "," + _FACT.replace("fact AS", f"{name} AS").replace("FROM looked_up", f"FROM looked_up_{name}")


_REFRESHED = (
    _with(PAYMENTS, RATES)
    + """,
raised AS (
  SELECT rate_date, base_currency, currency,
         rate_e8 + CASE WHEN year(rate_date) >= 2000 THEN 1000000 ELSE 0 END AS rate_e8,
         CAST(rate + CASE WHEN year(rate_date) >= 2000 THEN 0.01 ELSE 0 END AS DECIMAL(18,8)) AS rate
  FROM rates
),
known AS (SELECT * FROM payments WHERE payment_date <= DATE '2000-12-31'),
flawed AS (
  SELECT * REPLACE (CAST(CASE WHEN payment_id % 97 = 0 THEN NULL WHEN payment_id % 89 = 0 THEN payment_date - INTERVAL 12 MONTH
                         ELSE payment_date END AS DATE) AS payment_date) FROM known
),
repaired AS (
  SELECT * REPLACE (CAST(CASE WHEN payment_id % 79 = 0 AND payment_date >= DATE '2000-12-01' THEN payment_date - INTERVAL 1 MONTH
                         ELSE payment_date END AS DATE) AS payment_date) FROM payments WHERE payment_id % 83 <> 0
),
"""
    + _fact_of("loaded", "flawed", "rates")
    + ","
    + _fact_of("anew", "repaired", "raised")
    + """,
start AS (SELECT max(payment_date) - 7 AS start_date FROM loaded),
redone AS (
  SELECT a.* FROM anew a LEFT JOIN loaded l USING (payment_id)
  WHERE a.payment_date >= (SELECT start_date FROM start)
     OR (l.payment_id IS NOT NULL AND (l.payment_date IS NULL OR l.payment_date >= (SELECT start_date FROM start)))
)
SELECT * FROM redone
UNION ALL
SELECT * FROM loaded WHERE payment_date < (SELECT start_date FROM start) AND payment_id NOT IN (SELECT payment_id FROM redone)"""
)

ORACLES: dict[str, str] = {
    "bronze_projection": """
        SELECT props AS value, CAST(user_id AS VARCHAR) AS message_key, 'cdc.public.payments' AS topic,
               CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", CAST(ts AS TIMESTAMP) AS kafka_timestamp
        FROM events""",
    "decode_changes": f"{_CHANGES} SELECT * EXCLUDE (kafka_timestamp) FROM decoded",
    "decode_decimal_forms": f"{_with(EVENTS)} {_FORMS}",
    "decode_wide_decimals": f"{_with(EVENTS)} {_WIDE_FORMS}",
    "quarantine_rows": f"""{_CHANGES} SELECT topic, "partition", "offset", reason FROM decoded WHERE reason IS NOT NULL""",
    "quarantine_appended": f"""{_CHANGES} SELECT topic, "partition", "offset", reason FROM decoded WHERE reason IS NOT NULL""",
    "bronze_reconciliation": f"""{_CHANGES}
        SELECT topic, "partition", count(*) AS messages, count(*) FILTER (WHERE decode_ok) AS decoded,
               count(*) FILTER (WHERE reason IS NOT NULL) AS quarantined,
               count(*) FILTER (WHERE is_tombstone) AS tombstones,
               count(*) = count(*) FILTER (WHERE decode_ok) + count(*) FILTER (WHERE reason IS NOT NULL)
                          + count(*) FILTER (WHERE is_tombstone) AS reconciles
        FROM decoded GROUP BY 1, 2""",
    "latest_change_per_key": f"{_LATEST} SELECT * EXCLUDE (kafka_timestamp, reason, topic) FROM latest",
    "merge_two_batches": _CURRENT,
    "merge_replay": _CURRENT,
    "merge_reference_clauses": f"""{_CLAUSES}
        SELECT {_SILVER} FROM target t WHERE NOT EXISTS (
          SELECT 1 FROM second_half s WHERE s.payment_id = t.payment_id
            AND (s.is_deleted OR coalesce(s.cdc_lsn, -1) > coalesce(t.cdc_lsn, -1)))
        UNION ALL
        SELECT {_SILVER} FROM second_half s WHERE NOT is_deleted AND NOT EXISTS (
          SELECT 1 FROM target t WHERE t.payment_id = s.payment_id
            AND coalesce(s.cdc_lsn, -1) <= coalesce(t.cdc_lsn, -1))""",
    "silver_current": _CURRENT,
    "merchants_current": f"""{_with(_MERCHANTS)}
        SELECT merchant_id, merchant_name || ' Ltd' AS merchant_name, country_code, category,
               TIMESTAMP '2026-01-01 00:00:00' AS created_at, merchant_id * 10 + 3 AS cdc_lsn,
               TIMESTAMP '2026-01-01 00:00:00' AS cdc_source_ts
        FROM merchants WHERE category <> 'health'""",
    "refunds_current": f"""{_with(PAYMENTS)}
        SELECT payment_id AS refund_id, payment_id, CAST(-amount AS DECIMAL(12,2)) AS refund_amount,
               payment_status AS refund_reason, created_at, payment_id * 2 + 1 AS cdc_lsn,
               TIMESTAMP '2026-01-01 00:00:00' AS cdc_source_ts
        FROM payments""",
    "silver_after_compaction": _CURRENT,
    "silver_published_changes": _CURRENT,
    "silver_partial_replay": _CURRENT,
    "silver_batch_metrics": f"""{_CHANGES},
        batches AS (
          SELECT 'q' AS query_id, CAST(0 AS BIGINT) AS batch_id, * FROM decoded d JOIN ev ON ev.event_id = d."offset" WHERE hour(ev.ts) < 12
          UNION ALL SELECT 'q', 1, * FROM decoded d JOIN ev ON ev.event_id = d."offset"
          UNION ALL SELECT 'after-reset', 0, * FROM decoded d JOIN ev ON ev.event_id = d."offset" WHERE hour(ev.ts) < 12)
        SELECT query_id, batch_id, count(*) AS messages, count(*) FILTER (WHERE decode_ok) AS decoded,
               count(*) FILTER (WHERE reason IS NOT NULL) AS quarantined, count(*) FILTER (WHERE is_tombstone) AS tombstones, true AS reconciles
        FROM batches GROUP BY 1, 2""",
    "offset_coverage": """
        SELECT 'cdc.public.payments' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", min(event_id) AS first_offset, max(event_id) AS last_offset,
               max(event_id) - min(event_id) + 1 - count(*) AS missing_offsets, CAST(2 * count(*) FILTER (WHERE hour(ts) < 12) AS BIGINT) AS repeated_records
        FROM events GROUP BY 2""",
    "offset_gap_list": """
        SELECT topic, "partition", last + 1 AS first_missing, next - 1 AS last_missing FROM (
          SELECT 'cdc.public.payments' AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS last,
                 lead(event_id) OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS next
          FROM events WHERE hour(ts) < 12 OR event_id % 10 <> 3)
        WHERE next > last + 1""",
    "silver_stream": _CURRENT,
    "gold_daily_merchant_revenue": f"{_REVENUE} SELECT * FROM revenue",
    "gold_payment_method_mix": f"{_MIX} SELECT * FROM mix",
    "gold_from_change_events": _GOLD_OF_CHANGES,
    "gold_refreshed": _GOLD_OF_CHANGES,
    "stg_payments": f"{_with(PAYMENTS)} SELECT * EXCLUDE (cents) FROM payments",
    "stg_fx_rates": f"{_with(RATES)} SELECT * EXCLUDE (rate_e8) FROM rates",
    "stg_merchants": f"{_with(_MERCHANTS)} SELECT * FROM merchants",
    "stg_merchants_from_seed": f"{_with(_MERCHANTS)} SELECT * FROM merchants",
    "dim_merchants": f"{_with(_MERCHANTS)} SELECT * FROM merchants",
    "fx_parse_documents": f"{_with(RATES)} SELECT * EXCLUDE (rate_e8) FROM rates",
    "fx_landing_roundtrip": f"{_with(RATES)} SELECT * EXCLUDE (rate_e8) FROM rates",
    "fx_restatement": f"""{_with(RATES)}
        SELECT rate_date, base_currency, currency,
               CAST(rate + CASE WHEN rate_date < DATE '1999-01-01' THEN 0 WHEN currency = 'EUR' THEN 0.01
                                WHEN currency = 'GBP' THEN 0.02 ELSE 0 END AS DECIMAL(18,8)) AS rate
        FROM rates""",
    "fx_currencies": f"{_with(RATES)} SELECT DISTINCT currency FROM rates",
    "fx_asof_rate": f"{_LOOKUP} SELECT payment_id, currency, payment_date, rate, published_on FROM looked_up",
    "fx_asof_rate_salted": f"{_LOOKUP} SELECT payment_id, currency, payment_date, rate, published_on FROM looked_up",
    "fx_asof_rate_carried": f"{_LOOKUP} SELECT payment_id, currency, payment_date, rate, published_on FROM looked_up",
    "fx_to_base": f"""{_LOOKUP},
        divided AS (SELECT *, (cents * 100000000) // rate_e8 AS q, (cents * 100000000) % rate_e8 AS r FROM looked_up)
        SELECT payment_id, currency, amount,
               CAST(CAST(CASE WHEN 2 * r > rate_e8 OR (2 * r = rate_e8 AND q % 2 = 1) THEN q + 1 ELSE q END
                         AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount_base
        FROM divided""",
    "fx_rates_daily": f"""{_with(PAYMENTS, RATES, _DAILY)}
        SELECT *, published_rate IS NULL AND effective_rate IS NOT NULL AS is_carried_forward FROM daily""",
    "fx_missing_dates": _with(PAYMENTS, RATES, _MISSING.format(wanted="(SELECT DISTINCT currency FROM payments)"))
    + " SELECT * FROM missing",
    "fx_gap_runs": _with(PAYMENTS, RATES, _MISSING.format(wanted="(SELECT DISTINCT currency FROM payments)"))
    + " SELECT * FROM runs",
    "fct_payments_usd": f"{_FACTS} SELECT * FROM fact",
    "fct_payments_usd_incremental": _INCREMENTAL,
    "fct_payments_usd_refreshed": _REFRESHED,
    "fct_daily_revenue_usd": f"{_FACTS} {_DAILY_REVENUE}",
    "fct_daily_revenue_usd_refreshed": f"WITH fact AS ({_REFRESHED}) {_DAILY_REVENUE}",
    "shoppers_by_month": f"""{_FACTS}
        SELECT CAST(date_trunc('month', payment_date) AS DATE) AS period_start, merchant_id, count(DISTINCT shopper_id) AS distinct_shoppers
        FROM fact GROUP BY 1, 2""",
    "unconverted_by_currency": f"""{_FACTS}
        SELECT currency, count(*) AS payment_count, min(payment_date) AS first_date, max(payment_date) AS last_date
        FROM fact WHERE is_unconverted GROUP BY 1""",
    "dq_violations": _violations(),
    "dq_refreshed_checks": _REFRESHED_CHECKS,
    "dq_duplicate_payments": f"""{_with(PAYMENTS)}
        SELECT payment_id, CAST(2 AS BIGINT) AS row_count FROM payments WHERE payment_method = 'google_pay'""",
    "health_metrics": _HEALTH,
    "report_merchant_revenue": f"""{_REVENUE}
        SELECT * REPLACE (CAST(gross_amount AS VARCHAR) AS gross_amount, CAST(average_amount AS VARCHAR) AS average_amount)
        FROM revenue WHERE {_REPORT_RANGE}""",
    "report_revenue_pages": f"""{_REVENUE}
        SELECT * REPLACE (CAST(gross_amount AS VARCHAR) AS gross_amount, CAST(average_amount AS VARCHAR) AS average_amount)
        FROM revenue WHERE {_REPORT_RANGE}""",
    "report_revenue_totals": f"""{_REVENUE}
        SELECT currency, CAST(sum(gross_amount) AS VARCHAR) AS amount FROM revenue WHERE {_REPORT_RANGE} GROUP BY 1""",
    "report_method_mix": f"""{_MIX}
        SELECT country_code, payment_method, payment_count, share_pct FROM mix WHERE activity_date = DATE '1998-03-04'""",
    "report_known_merchants": f"""{_with(PAYMENTS, _MERCHANTS)}
        SELECT * FROM merchants WHERE merchant_id IN (
          SELECT merchant_id FROM payments WHERE payment_status IN ('authorized', 'captured'))""",
}
