"""The named queries as plain SQL for an independent engine.

Written from the definitions, not from the DataFrame code: joins, windows and recursive queries
are used freely here because the oracle only ever sees small tables.
"""

from __future__ import annotations

import re

TENANT = """
people AS (
  SELECT c.*, COALESCE(o.first_order, TIMESTAMP '1995-01-01') AS signup_ts
  FROM customer c
  LEFT JOIN (SELECT o_custkey, MIN(o_orderdate) AS first_order FROM orders GROUP BY 1) o
    ON o.o_custkey = c.c_custkey),
customers AS (
  SELECT c_custkey AS customer_id, signup_ts, 'N' || c_nationkey AS country_code,
         CAST(18 + c_custkey % 60 AS SMALLINT) AS age, lower(c_mktsegment) AS acquisition_channel,
         CASE WHEN c_custkey % 2 = 0 THEN 'iOS' ELSE 'Android' END AS device_os,
         c_custkey % 25 = 0 AS referral_code_used
  FROM people),
kyc_cases AS (
  SELECT c_custkey AS kyc_case_id, c_custkey AS customer_id,
         CASE WHEN verdict <> 'abandoned' OR c_custkey % 2 = 0
              THEN signup_ts + INTERVAL 1 HOUR END AS started_ts,
         CASE WHEN verdict <> 'abandoned' THEN signup_ts + INTERVAL 13 HOURS END AS completed_ts,
         verdict AS status,
         CASE verdict WHEN 'rejected' THEN 'refused'
                      WHEN 'abandoned' THEN 'not_finished' END AS failure_reason
  FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN 'approved' WHEN c_acctbal < -500 THEN 'rejected'
                       ELSE 'abandoned' END AS verdict FROM people)),
accounts AS (
  SELECT c_custkey + 1000000 AS account_id, c_custkey AS customer_id,
         signup_ts + INTERVAL 1 DAY AS opened_ts,
         CASE WHEN c_acctbal >= 5000 THEN 'premium' ELSE 'standard' END AS plan_tier,
         CASE WHEN c_nationkey % 2 = 0 THEN 'GBP' ELSE 'EUR' END AS base_currency
  FROM people WHERE c_acctbal >= 0),
marketing_spend AS (
  SELECT CAST(date_trunc('month', signup_ts) AS DATE) AS spend_month, acquisition_channel,
         CAST(25 * COUNT(*) AS DECIMAL(14,2)) AS spend_gbp, 1000 * COUNT(*) AS impressions,
         40 * COUNT(*) AS clicks
  FROM customers GROUP BY 1, 2),
experiment_assignments AS (
  SELECT customer_id AS assignment_id, customer_id,
         'welcome_bonus' AS experiment_name,
         CASE WHEN customer_id % 3 = 0 THEN 'bonus_10' ELSE 'control' END AS variant,
         signup_ts AS assigned_ts
  FROM customers),
movements AS (
  SELECT ((l_orderkey::HUGEINT * 10 + l_linenumber) * 100000000000 + l_partkey) * 100000000000
           + l_suppkey AS transaction_id,
         a.account_id, l_shipdate AS transaction_ts,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'cash_in' WHEN '2' THEN 'card_payment'
           WHEN '3' THEN 'bank_transfer' WHEN '4' THEN 'fx_exchange'
           WHEN '5' THEN 'cash_withdrawal' END AS transaction_type,
         CASE WHEN l_returnflag <> 'R' THEN 'completed' WHEN l_linestatus = 'O' THEN 'reversed'
              ELSE 'failed' END AS status,
         CAST(round(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST('0.01' AS DECIMAL(3,2)), 2)
              AS DECIMAL(14,2)) AS amount_gbp,
         a.base_currency, l_partkey, l_suppkey, l_linenumber
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN accounts a ON a.customer_id = o_custkey),
fees AS (
  SELECT *, status = 'completed' AS ok,
         CAST(round(amount_gbp * CAST('0.0065' AS DECIMAL(5,4)), 2) AS DECIMAL(12,2)) AS interchange,
         CAST(round(amount_gbp * CAST('0.0040' AS DECIMAL(5,4)), 2) AS DECIMAL(12,2)) AS spread,
         CAST(round(CAST('0.02' AS DECIMAL(12,2))
                    + amount_gbp * CAST('0.0015' AS DECIMAL(5,4)), 2) AS DECIMAL(12,2)) AS card_cost
  FROM movements),
transactions AS (
  SELECT transaction_id, account_id, transaction_ts, transaction_type, status, amount_gbp,
         CAST(CASE WHEN ok AND transaction_type = 'bank_transfer' AND amount_gbp > 250 THEN '0.25'
                   WHEN ok AND transaction_type = 'cash_withdrawal' AND amount_gbp > 200 THEN '1.00'
                   ELSE '0.00' END AS DECIMAL(12,2)) AS fee_revenue_gbp,
         CASE WHEN ok AND transaction_type = 'card_payment' THEN interchange
              ELSE CAST('0.00' AS DECIMAL(12,2)) END AS interchange_revenue_gbp,
         CASE WHEN ok AND transaction_type = 'fx_exchange' THEN spread
              ELSE CAST('0.00' AS DECIMAL(12,2)) END AS fx_spread_revenue_gbp,
         CASE WHEN NOT ok THEN CAST('0.01' AS DECIMAL(12,2))
              WHEN transaction_type = 'card_payment' THEN card_cost
              WHEN transaction_type = 'bank_transfer' THEN CAST('0.04' AS DECIMAL(12,2))
              WHEN transaction_type = 'fx_exchange' THEN CAST('0.03' AS DECIMAL(12,2))
              WHEN transaction_type = 'cash_withdrawal' THEN CAST('0.35' AS DECIMAL(12,2))
              ELSE CAST('0.02' AS DECIMAL(12,2)) END AS processing_cost_gbp
  FROM fees),
money AS (
  SELECT *, status = 'completed' AS ok,
         fee_revenue_gbp + interchange_revenue_gbp + fx_spread_revenue_gbp AS revenue,
         fee_revenue_gbp + interchange_revenue_gbp + fx_spread_revenue_gbp - processing_cost_gbp
           AS margin
  FROM transactions),
fundings AS (
  SELECT a.customer_id, a.account_id, m.transaction_id, m.transaction_ts, m.amount_gbp
  FROM (SELECT *, row_number() OVER (PARTITION BY account_id
                                     ORDER BY transaction_ts, transaction_id) AS n
        FROM money WHERE ok AND transaction_type = 'cash_in') m
  JOIN accounts a USING (account_id) WHERE m.n = 1),
incentives AS (
  SELECT m.*, CASE WHEN f.transaction_id IS NOT NULL THEN CAST('10.00' AS DECIMAL(12,2))
                   ELSE CAST('0.00' AS DECIMAL(12,2)) END AS incentive_cost_gbp
  FROM money m
  LEFT JOIN (SELECT f.transaction_id FROM fundings f
             JOIN experiment_assignments e USING (customer_id) WHERE e.variant = 'bonus_10') f
    USING (transaction_id)),
lifecycle AS (
  SELECT customer_id * 8 AS event_id, customer_id, signup_ts AS event_ts,
         'signup_completed' AS event_name FROM customers
  UNION ALL
  SELECT kyc_case_id * 8 + 1, customer_id, started_ts, 'kyc_started'
  FROM kyc_cases WHERE started_ts IS NOT NULL
  UNION ALL
  SELECT kyc_case_id * 8 + 2, customer_id, completed_ts,
         CASE status WHEN 'approved' THEN 'kyc_approved' ELSE 'kyc_rejected' END
  FROM kyc_cases WHERE completed_ts IS NOT NULL
  UNION ALL
  SELECT customer_id * 8 + 3, customer_id, opened_ts, 'account_opened' FROM accounts),
product_events AS (
  SELECT event_id, customer_id, event_ts, event_name,
         's' || lpad(CAST(customer_id AS VARCHAR), 7, '0') AS session_id,
         CAST(NULL AS DECIMAL(14,2)) AS event_value
  FROM lifecycle
  UNION ALL
  SELECT customer_id * 8 + 4, customer_id, transaction_ts, 'first_funding',
         'funding-' || customer_id, amount_gbp FROM fundings
  UNION ALL
  SELECT a.customer_id * 8 + 5, a.customer_id, MIN(m.transaction_ts), 'first_transaction',
         'txn-' || a.customer_id, NULL
  FROM money m JOIN accounts a USING (account_id)
  WHERE m.ok AND m.transaction_type <> 'cash_in' GROUP BY a.customer_id),
card_transactions AS (
  SELECT transaction_id,
         'M' || (l_partkey % 6) AS merchant_category,
         'N' || (l_suppkey % 25) AS merchant_country, l_linenumber <= 5 AS card_present
  FROM movements WHERE transaction_type = 'card_payment'),
transfers AS (
  SELECT transaction_id, CASE WHEN l_partkey % 5 < 2 THEN 'inbound' ELSE 'outbound' END AS direction,
         CASE WHEN l_linenumber = 7 THEN 'swift' WHEN base_currency = 'GBP' THEN 'faster_payments'
              ELSE 'sepa' END AS transfer_rail,
         'N' || (l_partkey % 25) AS counterparty_country
  FROM movements WHERE transaction_type = 'bank_transfer'),
rates AS (
  SELECT * FROM (VALUES ('GBP', 1.00::DOUBLE), ('EUR', 0.86::DOUBLE), ('USD', 0.79::DOUBLE),
                        ('CHF', 0.89::DOUBLE)) r(currency, gbp)),
fx_transactions AS (
  SELECT transaction_id, base_currency AS from_currency, to_currency,
         round(sold, 2) AS source_amount, round(sold * s.gbp / t.gbp, 2) AS target_amount,
         round(sold * s.gbp / t.gbp / sold, 8) AS quoted_rate, 40.0::DOUBLE AS spread_bps
  FROM (SELECT m.*, CAST(amount_gbp AS DOUBLE) / r.gbp AS sold,
               CASE WHEN base_currency = 'GBP' THEN ['EUR', 'USD', 'CHF'][l_suppkey % 3 + 1]
                    ELSE ['GBP', 'USD', 'CHF'][l_suppkey % 3 + 1] END AS to_currency
        FROM movements m JOIN rates r ON r.currency = base_currency
        WHERE transaction_type = 'fx_exchange') x
  JOIN rates s ON s.currency = base_currency JOIN rates t ON t.currency = to_currency),
funded AS (SELECT DISTINCT customer_id FROM product_events WHERE event_name = 'first_funding'),
spend AS (
  SELECT acquisition_channel, SUM(spend_gbp) AS spend FROM marketing_spend GROUP BY 1),
holders AS (
  SELECT a.account_id, a.customer_id, c.acquisition_channel, COUNT(*) AS n,
         COUNT(*) FILTER (m.ok) AS done, SUM(m.amount_gbp) FILTER (m.ok) AS volume,
         SUM(m.margin) FILTER (m.ok) AS margin, SUM(m.margin) AS margin_any,
         BOOL_OR(m.ok AND m.transaction_type = 'fx_exchange') AS used_fx,
         MIN(m.transaction_ts) FILTER (m.ok AND m.transaction_type = 'cash_in') AS funded_ts
  FROM accounts a JOIN customers c USING (customer_id) JOIN money m USING (account_id)
  GROUP BY 1, 2, 3),
windows AS (
  SELECT h.account_id, h.acquisition_channel, h.used_fx, h.funded_ts,
         COUNT(m.transaction_id) FILTER (m.transaction_ts >= h.funded_ts + INTERVAL 180 DAYS
           AND m.transaction_ts < h.funded_ts + INTERVAL 360 DAYS) AS w1,
         COUNT(m.transaction_id) FILTER (m.transaction_ts >= h.funded_ts + INTERVAL 360 DAYS
           AND m.transaction_ts < h.funded_ts + INTERVAL 540 DAYS) AS w2
  FROM holders h
  LEFT JOIN money m ON m.account_id = h.account_id AND m.ok AND m.transaction_type <> 'cash_in'
  WHERE h.funded_ts IS NOT NULL
  GROUP BY 1, 2, 3, 4),
funnel AS (
  SELECT COUNT(*) AS signups,
         COUNT(*) FILTER (customer_id IN
           (SELECT customer_id FROM kyc_cases WHERE status = 'approved')) AS kyc_approved,
         COUNT(*) FILTER (customer_id IN (SELECT customer_id FROM accounts)) AS accounts_opened,
         COUNT(*) FILTER (customer_id IN (SELECT customer_id FROM funded)) AS first_funding,
         COUNT(*) FILTER (customer_id IN (SELECT customer_id FROM product_events
           WHERE event_name = 'first_transaction')) AS first_transaction
  FROM customers),
conversion AS (
  SELECT acquisition_channel, COUNT(*) AS signups,
         COUNT(*) FILTER (customer_id IN (SELECT customer_id FROM funded)) AS funded_customers
  FROM customers GROUP BY 1),
kpis AS (
  SELECT (SELECT COUNT(*) FROM customers) AS total_signups,
         (SELECT COUNT(*) FROM kyc_cases WHERE status = 'approved') AS kyc_approved,
         (SELECT COUNT(*) FROM accounts) AS accounts_opened,
         (SELECT COUNT(*) FROM product_events WHERE event_name = 'first_funding')
           AS funded_customers,
         (SELECT COUNT(*) FROM product_events WHERE event_name = 'first_transaction')
           AS transacting_customers,
         (SELECT COUNT(*) FROM transactions) AS total_transactions,
         (SELECT CAST(SUM(amount_gbp) AS DOUBLE) FROM money WHERE ok)
           AS completed_transaction_volume_gbp,
         (SELECT CAST(SUM(margin) AS DOUBLE) FROM money WHERE ok) AS total_contribution_margin_gbp),
channel_performance AS (
  SELECT v.acquisition_channel, v.signups, v.funded_customers,
         [[pct funded_customers | signups | 2]] AS signup_to_funding_pct,
         CAST(spend AS DOUBLE) AS acquisition_spend_gbp,
         [[money spend | signups | 2]] AS cac_gbp,
         [[money spend | funded_customers | 2]]
           AS cost_per_funded_customer_gbp,
         avg_transaction_volume_gbp, avg_contribution_margin_gbp
  FROM conversion v JOIN spend USING (acquisition_channel)
  JOIN (SELECT acquisition_channel,
               [[money SUM(volume) | COUNT(volume) | 2]] AS avg_transaction_volume_gbp,
               [[money SUM(margin) | COUNT(margin) | 2]] AS avg_contribution_margin_gbp
        FROM holders GROUP BY 1) USING (acquisition_channel)),
participants AS (
  SELECT e.*, c.acquisition_channel, f.customer_id IS NOT NULL AS activated, x.margin,
         COALESCE(x.incentive, 0) AS incentive
  FROM experiment_assignments e JOIN customers c USING (customer_id)
  LEFT JOIN funded f USING (customer_id)
  LEFT JOIN (SELECT a.customer_id, SUM(i.margin) FILTER (i.ok) AS margin,
                    SUM(i.incentive_cost_gbp) FILTER (i.ok) AS incentive
             FROM accounts a LEFT JOIN incentives i USING (account_id) GROUP BY 1) x
    USING (customer_id)),
experiment_performance AS (
  SELECT variant, COUNT(*) AS assigned_customers, COUNT(*) FILTER (activated) AS activated_customers,
         [[pct COUNT(*) FILTER (activated) | COUNT(*) | 2]]
           AS activation_rate_pct,
         CAST(SUM(incentive) AS DOUBLE) AS total_incentive_cost_gbp,
         [[money SUM(margin) FILTER (activated) | COUNT(margin) FILTER (activated) | 2]] AS avg_margin_before_incentive_gbp,
         [[money SUM(margin - incentive) FILTER (activated) | COUNT(margin) FILTER (activated) | 2]] AS avg_margin_after_incentive_gbp
  FROM participants GROUP BY 1),
arms AS (
  SELECT experiment_name, acquisition_channel, variant, COUNT(*) AS assigned,
         COUNT(*) FILTER (activated) AS hits, SUM(incentive) AS cost,
         SUM(margin) FILTER (activated) AS margin_sum, COUNT(margin) FILTER (activated) AS margin_n
  FROM participants GROUP BY 1, 2, 3),
fx_customer_segments AS (
  SELECT CASE WHEN used_fx THEN 'FX user' ELSE 'Non-FX user' END AS customer_segment,
         COUNT(*) AS customers,
         [[count SUM(done) | COUNT(done) | 2]] AS avg_completed_transactions,
         [[money SUM(volume) | COUNT(volume) | 2]] AS avg_transaction_volume_gbp,
         [[money SUM(margin) | COUNT(margin) | 2]] AS avg_contribution_margin_gbp
  FROM holders WHERE funded_ts IS NOT NULL GROUP BY 1),
fx_retention AS (
  SELECT CASE WHEN used_fx THEN 'FX user' ELSE 'Non-FX user' END AS customer_segment,
         COUNT(*) AS eligible_customers, COUNT(*) FILTER (w1 >= 2) AS retained_d30,
         [[pct COUNT(*) FILTER (w1 >= 2) | COUNT(*) | 2]] AS d30_retention_pct
  FROM windows WHERE funded_ts <= TIMESTAMP '2001-11-05' - INTERVAL 360 DAYS GROUP BY 1),
retention_cohorts AS (
  SELECT CAST(date_trunc('month', funded_ts) AS DATE) AS funding_cohort,
         COUNT(*) AS funded_customers, COUNT(*) FILTER (w1 >= 2) AS retained_d30,
         [[pct COUNT(*) FILTER (w1 >= 2) | COUNT(*) | 2]] AS d30_retention_pct,
         COUNT(*) FILTER (w2 >= 2) AS retained_d60,
         [[pct COUNT(*) FILTER (w2 >= 2) | COUNT(*) | 2]] AS d60_retention_pct
  FROM windows
  WHERE funded_ts < date_trunc('month', TIMESTAMP '2001-11-05' - INTERVAL 540 DAYS) GROUP BY 1),
transaction_economics AS (
  SELECT transaction_type, COUNT(*) FILTER (ok) AS completed_transactions,
         CAST(SUM(amount_gbp) FILTER (ok) AS DOUBLE) AS transaction_volume_gbp,
         CAST(SUM(revenue) FILTER (ok) AS DOUBLE) AS revenue_gbp,
         CAST(SUM(processing_cost_gbp) FILTER (ok) AS DOUBLE) AS processing_cost_gbp,
         CAST(SUM(margin) FILTER (ok) AS DOUBLE) AS contribution_margin_gbp,
         [[money SUM(margin) FILTER (ok) | COUNT(*) FILTER (ok) | 4]]
           AS avg_margin_per_transaction_gbp
  FROM money GROUP BY 1)
"""

LEDGER = """
evt AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
typed AS (
  SELECT event_id AS request_id, CAST(user_id // 50 AS VARCHAR) AS session_id,
         user_id || ':' || k AS idempotency_key,
         '00000000-0000-4000-8000-' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS source_account_id,
         '00000000-0000-4000-8000-'
           || lpad(CAST(CASE WHEN k = 50 THEN user_id ELSE user_id + 1 + k % 3 END AS VARCHAR),
                   12, '0') AS destination_account_id,
         100 * k + CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS amount_minor,
         'GBP' AS currency, ts
  FROM evt),
valid AS (
  SELECT * FROM typed
  WHERE amount_minor >= 1 AND amount_minor <= 1000000000000
    AND source_account_id <> destination_account_id),
users AS (SELECT user_id, MIN(ts) AS created_at FROM evt GROUP BY 1),
ledger_accounts AS (
  SELECT '00000000-0000-4000-8000-' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS account_id,
         'User ' || user_id AS owner_name, 'GBP' AS currency,
         CAST(30000 AS BIGINT) AS opening_balance_minor, CAST(30000 AS BIGINT) AS balance_minor,
         created_at, CAST(user_id // 50 AS VARCHAR) AS session_id
  FROM users),
user_sessions AS (
  SELECT CAST(user_id AS VARCHAR) AS session_id, sha256(CAST(user_id AS VARCHAR)) AS token_hash,
         created_at, created_at + INTERVAL 30 MINUTES AS expires_at, created_at AS window_start,
         0 AS request_count FROM users),
ledger_sessions AS (SELECT * FROM user_sessions),
user_accounts AS (
  SELECT '00000000-0000-4000-8000-' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS account_id,
         CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS session_id
  FROM users),
journal AS (
  SELECT idempotency_key, request_id, session_id, source_account_id, destination_account_id,
         amount_minor, currency, ts AS created_at
  FROM (SELECT v.* REPLACE (sha256(v.session_id || ':' || v.idempotency_key) AS idempotency_key),
               row_number() OVER (PARTITION BY v.session_id, v.idempotency_key
                                  ORDER BY ts, request_id) AS n
        FROM valid v
        JOIN ledger_accounts s ON s.account_id = source_account_id AND s.session_id = v.session_id
        JOIN ledger_accounts d ON d.account_id = destination_account_id
                              AND d.session_id = v.session_id)
  WHERE n = 1),
ledger_transfers AS (
  SELECT *, lpad(CAST(request_id AS VARCHAR), 12, '0') AS transfer_id FROM journal),
postings AS (
  SELECT transfer_id, created_at, source_account_id AS account_id, -amount_minor AS signed_minor,
         'outgoing' AS direction FROM ledger_transfers
  UNION ALL
  SELECT transfer_id, created_at, destination_account_id, amount_minor, 'incoming'
  FROM ledger_transfers),
running AS (
  SELECT p.*, CAST(a.opening_balance_minor + SUM(signed_minor) OVER (
                PARTITION BY p.account_id ORDER BY p.created_at, transfer_id
                ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance_after_minor
  FROM postings p JOIN ledger_accounts a USING (account_id)),
bodies AS (
  SELECT request_id, session_id, ts,
         CASE request_id % 23 WHEN 14 THEN ' ' WHEN 15 THEN repeat('k', 129)
              ELSE idempotency_key END AS idempotency_key,
         '{"source_account_id": "'
         || CASE request_id % 23 WHEN 11 THEN 'not-a-uuid'
                 WHEN 12 THEN upper(replace(source_account_id, '-', ''))
                 ELSE source_account_id END
         || '", "destination_account_id": "' || destination_account_id || '", "amount_minor": '
         || CASE request_id % 23 WHEN 0 THEN '"' || amount_minor || '"'
                 WHEN 1 THEN amount_minor || '.5' WHEN 2 THEN 'true' WHEN 3 THEN '-1'
                 WHEN 4 THEN '1000000000001' WHEN 5 THEN amount_minor || ', "admin": true'
                 WHEN 6 THEN 'null' WHEN 7 THEN amount_minor || '.0'
                 ELSE CAST(amount_minor AS VARCHAR) END
         || CASE request_id % 23 WHEN 8 THEN ', "currency": "USD"' WHEN 9 THEN ''
                 WHEN 10 THEN ', "currency": null' ELSE ', "currency": "GBP"' END
         || CASE request_id % 23 WHEN 13 THEN '' ELSE '}' END AS body
  FROM typed),
parsed AS (
  SELECT *, CASE WHEN json_valid(body) THEN body END AS doc FROM bodies),
fields AS (
  SELECT *, json_extract_string(doc, '$.source_account_id') AS src,
         json_extract_string(doc, '$.destination_account_id') AS dst,
         json_type(doc, '$.amount_minor') AS amount_kind,
         json_type(doc, '$.currency') AS currency_kind
  FROM parsed),
canonical AS (
  SELECT *,
         CASE WHEN regexp_full_match(src, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}')
                OR regexp_full_match(src, '[0-9a-fA-F]{32}')
              THEN CAST(CAST(src AS UUID) AS VARCHAR) END AS source_account_id,
         CASE WHEN regexp_full_match(dst, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}')
              THEN dst END AS destination_account_id,
         CASE WHEN amount_kind IN ('UBIGINT', 'BIGINT')
              THEN CAST(json_extract_string(doc, '$.amount_minor') AS BIGINT) END AS amount_minor
  FROM fields),
account_bodies AS (
  SELECT event_id AS request_id, CAST(user_id // 50 AS VARCHAR) AS session_id, ts,
         CASE event_id % 11 WHEN 0 THEN '{"owner_name": "  "}'
              WHEN 1 THEN '{"owner_name": "A", "opening_balance_minor": -1}'
              WHEN 2 THEN '{"owner_name": "A", "opening_balance_minor": 0.5}'
              WHEN 3 THEN '{"owner_name": "A", "currency": "USD"}'
              WHEN 4 THEN '{"owner_name": "A", "admin": true}'
              WHEN 5 THEN '[]'
              WHEN 6 THEN '{"owner_name": "  ' || event_type || ' "}'
              ELSE '{"owner_name": "' || event_type || '", "opening_balance_minor": '
                   || (k * 100) || '}' END AS body
  FROM evt)
"""


def _quotients(sql: str) -> str:
    """Expand [[kind numerator | denominator | places]] into an exactly rounded quotient.

    Whole-number arithmetic, halves away from zero: rounding a double quotient would send ties
    either way. Money is turned into pennies through its text, counts are taken as they are.
    """

    def expand(match: re.Match) -> str:
        kind, top, bottom, places = (part.strip() for part in match.groups())
        if kind == "money":
            units, scale = f"CAST(replace(CAST({top} AS VARCHAR), '.', '') AS HUGEINT)", 2
        else:
            units, scale = f"CAST({top} AS HUGEINT)" + (" * 100" if kind == "pct" else ""), 0
        n = f"NULLIF(CAST({bottom} AS HUGEINT), 0)"
        step = 10 ** (int(places) - scale)
        return (
            f"(CASE WHEN {units} < 0 THEN -1 ELSE 1 END "
            f"* CAST((2 * abs({units}) * {step} + {n}) // (2 * {n}) AS DOUBLE) "
            f"/ CAST({10 ** int(places)} AS DOUBLE))"
        )

    return re.sub(r"\[\[(\w+) (.+?) \| (.+?) \| (\d)\]\]", expand, sql, flags=re.DOTALL)


def _pct(part: str, whole: str, name: str) -> str:
    return f"[[pct {part} | {whole} | 2]] AS {name}"


def _mean(value: str, name: str, kind: str = "money") -> str:
    return f"[[{kind} SUM({value}) | COUNT({value}) | 2]] AS {name}"


_ERFC = (
    "t * exp(-x * x - 1.26551223 + t * (1.00002368 + t * (0.37409196 + t * (0.09678418 + t * "
    "(-0.18628806 + t * (0.27886807 + t * (-1.13520398 + t * (1.48851587 + t * (-0.82215223 "
    "+ t * 0.17087277)))))))))"
)


def _readout(keys: str, columns: str) -> str:
    """Treatment against control per ``keys`` (a column list, possibly empty)."""
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
    SELECT {lead}{columns} FROM (
      SELECT *, CAST(tc AS DOUBLE) AS incentive_cost_gbp, tr AS treatment_rate,
             cr AS control_rate, lift / NULLIF(cr, 0) AS relative_lift,
             lift * tn AS incremental_activations, cm AS control_margin_gbp,
             CASE WHEN lift * tn > 0 THEN CAST(tc AS DOUBLE) / (lift * tn)
                  ELSE CAST('inf' AS DOUBLE) END AS break_even_margin_gbp,
             lift - 1.96 * own AS ci_lower, lift + 1.96 * own AS ci_upper, z AS z_stat,
             {_ERFC} AS p_value
      FROM (SELECT *, abs(z) / sqrt(CAST(2 AS DOUBLE)) AS x,
                   1 / (1 + 0.5 * (abs(z) / sqrt(CAST(2 AS DOUBLE)))) AS t
            FROM (SELECT *, tr - cr AS lift,
                         (tr - cr) / NULLIF(sqrt(pool * (1 - pool)
                           * (CAST(1 AS DOUBLE) / tn + CAST(1 AS DOUBLE) / cn)), 0) AS z,
                         sqrt(tr * (1 - tr) / tn + cr * (1 - cr) / cn) AS own
                  FROM (SELECT *, CAST(th AS DOUBLE) / tn AS tr, CAST(ch AS DOUBLE) / cn AS cr,
                               CAST(th + ch AS DOUBLE) / (tn + cn) AS pool
                        FROM (SELECT {lead}
                                SUM(hits) FILTER (variant = 'bonus_10') AS th,
                                SUM(assigned) FILTER (variant = 'bonus_10') AS tn,
                                SUM(hits) FILTER (variant = 'control') AS ch,
                                SUM(assigned) FILTER (variant = 'control') AS cn,
                                SUM(cost) FILTER (variant = 'bonus_10') AS tc,
                                COALESCE(CAST(SUM(margin_sum) FILTER (variant = 'control') AS DOUBLE)
                                  / NULLIF(SUM(margin_n) FILTER (variant = 'control'), 0), 0) AS cm
                              FROM arms {group})))))"""


_R = "CAST(printf('%.8e', {0}) AS DOUBLE) AS {0}".format
_TEST = ", ".join(_R(c) for c in ("lift", "z_stat", "p_value", "ci_lower", "ci_upper"))
_PAYBACK = (
    "CAST(printf('%.8e', CASE WHEN break_even_margin_gbp > 0 "
    "THEN control_margin_gbp / break_even_margin_gbp * 100 ELSE 0 END) AS DOUBLE) AS payback_pct"
)
_ECONOMICS = (
    ", ".join(
        _R(c)
        for c in (
            "treatment_rate",
            "control_rate",
            "relative_lift",
            "incremental_activations",
            "incentive_cost_gbp",
            "break_even_margin_gbp",
            "control_margin_gbp",
        )
    )
    + ", "
    + _PAYBACK
)
_DECISION = (
    "COALESCE(p_value < 0.05 AND lift > 0, FALSE) AS significant, "
    "control_margin_gbp >= break_even_margin_gbp AS launch"
)

_EVENT = (
    "event_id, customer_id, event_ts, event_name, session_id, "
    "CAST(event_value AS DOUBLE) AS event_value"
)


def _label(code: str) -> str:
    words = f"string_split({code}, '_')"
    return f"array_to_string([upper(w[1]) || w[2:] for w in {words}], ' ')"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _check(name: str, table: str, violations: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, "
        f"CAST(n AS BIGINT) AS violations, n = 0 AS passed FROM ({violations})"
    )


def _unique(table: str, columns: str) -> str:
    filled = " AND ".join(f"{c} IS NOT NULL" for c in columns.split(","))
    return _check(
        f"unique:{columns}",
        table,
        f"SELECT COUNT(*) AS n FROM (SELECT {columns} FROM {table} WHERE {filled} "
        f"GROUP BY {columns} HAVING COUNT(*) > 1)",
    )


def _bad_rows(name: str, table: str, condition: str) -> str:
    return _check(name, table, f"SELECT COUNT(*) FILTER ({condition}) AS n FROM {table}")


def _orphans(table: str, column: str, parent: str, parent_column: str) -> str:
    return _check(
        f"foreign_key:{column}",
        table,
        f"SELECT COUNT(*) AS n FROM {table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})",
    )


def _domain(table: str, column: str, values: str) -> str:
    quoted = ", ".join(f"'{v}'" for v in values.split())
    return _bad_rows(f"domain:{column}", table, f"{column} NOT IN ({quoted})")


_NOT_NULL = {
    "customers": "customer_id signup_ts country_code age acquisition_channel device_os "
    "referral_code_used",
    "kyc_cases": "kyc_case_id customer_id status",
    "accounts": "account_id customer_id opened_ts plan_tier base_currency",
    "marketing_spend": "spend_month acquisition_channel spend_gbp impressions clicks",
    "experiment_assignments": "assignment_id customer_id experiment_name variant assigned_ts",
    "product_events": "event_id customer_id event_ts event_name",
    "transactions": "transaction_id account_id transaction_ts transaction_type status amount_gbp "
    "fee_revenue_gbp interchange_revenue_gbp fx_spread_revenue_gbp processing_cost_gbp "
    "incentive_cost_gbp",
    "card_transactions": "transaction_id",
    "transfers": "transaction_id direction transfer_rail",
    "fx_transactions": "transaction_id from_currency to_currency source_amount target_amount "
    "quoted_rate spread_bps",
}
_LEDGER_NOT_NULL = {
    "ledger_sessions": "session_id token_hash created_at expires_at window_start request_count",
    "ledger_accounts": "account_id owner_name currency opening_balance_minor balance_minor "
    "created_at",
    "ledger_transfers": "transfer_id idempotency_key source_account_id destination_account_id "
    "amount_minor currency created_at",
}


def _not_null(columns: dict[str, str]) -> list[str]:
    return [
        _bad_rows(f"not_null:{c}", table, f"{c} IS NULL")
        for table, names in columns.items()
        for c in names.split()
    ]


def _contract(check: str, view: str, test: str) -> str:
    return (
        f"SELECT '{check}' AS check_name, '{view}' AS table_name, "
        f"CAST(CASE WHEN ({test}) THEN 0 ELSE 1 END AS BIGINT) AS violations, "
        f"COALESCE(({test}), FALSE) AS passed"
    )


_VIEWS = (
    "kpis channel_performance transaction_economics experiment_performance retention_cohorts "
    "fx_customer_segments fx_retention"
).split()

_CONTRACTS = [_contract("non_empty", v, f"SELECT COUNT(*) > 0 FROM {v}") for v in _VIEWS] + [
    _contract(
        "funnel_monotone",
        "kpis",
        "SELECT total_signups >= kyc_approved AND kyc_approved >= funded_customers "
        "AND funded_customers >= transacting_customers - 10 FROM kpis",
    ),
    _contract(
        "approved_equals_accounts", "kpis", "SELECT kyc_approved = accounts_opened FROM kpis"
    ),
    _contract(
        "signups_reconcile",
        "channel_performance",
        "(SELECT SUM(signups) FROM channel_performance) = (SELECT total_signups FROM kpis)",
    ),
    _contract(
        "funded_reconcile",
        "channel_performance",
        "(SELECT SUM(funded_customers) FROM channel_performance) "
        "= (SELECT funded_customers FROM kpis)",
    ),
    _contract(
        "conversion_recomputes",
        "channel_performance",
        "SELECT COUNT(*) = 0 FROM channel_performance WHERE abs(round(CAST(100 AS DOUBLE) "
        "* funded_customers / signups, 2) - signup_to_funding_pct) > 0.0100001",
    ),
    _contract(
        "cost_recomputes",
        "channel_performance",
        "SELECT COUNT(*) = 0 FROM channel_performance WHERE abs(round(acquisition_spend_gbp "
        "/ funded_customers, 2) - cost_per_funded_customer_gbp) > 0.0100001",
    ),
    _contract(
        "margin_reconciles",
        "transaction_economics",
        "abs((SELECT SUM(contribution_margin_gbp) FROM transaction_economics) "
        "- (SELECT total_contribution_margin_gbp FROM kpis)) <= 0.0100001",
    ),
    _contract(
        "volume_reconciles",
        "transaction_economics",
        "abs((SELECT SUM(transaction_volume_gbp) FROM transaction_economics) "
        "- (SELECT completed_transaction_volume_gbp FROM kpis)) <= 0.0100001",
    ),
    _contract(
        "margin_recomputes",
        "transaction_economics",
        "SELECT COUNT(*) = 0 FROM transaction_economics "
        "WHERE abs(revenue_gbp - processing_cost_gbp - contribution_margin_gbp) > 0.0100001",
    ),
    _contract(
        "arms_cover_customers",
        "experiment_performance",
        "(SELECT SUM(assigned_customers) FROM experiment_performance) "
        "= (SELECT total_signups FROM kpis)",
    ),
    _contract(
        "arms_are_known",
        "experiment_performance",
        "SELECT list_sort(list(variant)) = ['bonus_10', 'control'] FROM experiment_performance",
    ),
    _contract(
        "control_costs_nothing",
        "experiment_performance",
        "SELECT total_incentive_cost_gbp = 0 FROM experiment_performance "
        "WHERE variant = 'control'",
    ),
    _contract(
        "bonus_per_activation",
        "experiment_performance",
        "SELECT abs(total_incentive_cost_gbp - 10 * activated_customers) < 1e-9 "
        "FROM experiment_performance WHERE variant = 'bonus_10'",
    ),
    _contract(
        "rates_are_percentages",
        "retention_cohorts",
        "SELECT COUNT(*) = 0 FROM retention_cohorts WHERE NOT (d30_retention_pct BETWEEN 0 AND 100) "
        "OR NOT (d60_retention_pct BETWEEN 0 AND 100)",
    ),
    _contract(
        "rate_recomputes",
        "retention_cohorts",
        "SELECT COUNT(*) = 0 FROM retention_cohorts WHERE abs(round(CAST(100 AS DOUBLE) "
        "* retained_d30 / funded_customers, 2) - d30_retention_pct) > 0.0100001",
    ),
    _contract(
        "segments_partition_funded",
        "fx_customer_segments",
        "(SELECT SUM(customers) FROM fx_customer_segments) = (SELECT funded_customers FROM kpis)",
    ),
]


_CHANNEL_TABLE = (
    f'SELECT {_label("acquisition_channel")} AS "Channel", signups AS "Signups", '
    'funded_customers AS "Funded customers", signup_to_funding_pct AS "Signup → funding %", '
    'cac_gbp AS "CAC £", cost_per_funded_customer_gbp AS "Cost / funded £", '
    'avg_transaction_volume_gbp AS "Avg volume £", avg_contribution_margin_gbp AS "Avg margin £" '
    "FROM channel_performance"
)
_ECONOMICS_TABLE = (
    f'SELECT {_label("transaction_type")} AS "Transaction type", '
    'completed_transactions AS "Completed transactions", transaction_volume_gbp AS "Volume £", '
    'revenue_gbp AS "Revenue £", processing_cost_gbp AS "Processing cost £", '
    'contribution_margin_gbp AS "Contribution margin £", '
    'avg_margin_per_transaction_gbp AS "Avg margin / transaction £" FROM transaction_economics'
)

_ID = "CAST(transaction_id AS VARCHAR) AS transaction_id"
TENANT_QUERIES = {
    "q01_funnel": "SELECT * FROM funnel",
    "q02_funnel_rates": "SELECT "
    + ", ".join(
        (
            _pct("kyc_approved", "signups", "signup_to_kyc_pct"),
            _pct("accounts_opened", "kyc_approved", "kyc_to_account_pct"),
            _pct("first_funding", "accounts_opened", "account_to_funding_pct"),
            _pct("first_transaction", "first_funding", "funding_to_transaction_pct"),
        )
    )
    + " FROM funnel",
    "q03_kyc_by_channel": "SELECT acquisition_channel, COUNT(*) AS signups, "
    "COUNT(*) FILTER (status = 'approved') AS kyc_approved, "
    + _pct("COUNT(*) FILTER (status = 'approved')", "COUNT(*)", "kyc_approval_pct")
    + " FROM customers JOIN kyc_cases USING (customer_id) GROUP BY 1",
    "q04_acct_to_funding": "SELECT acquisition_channel, COUNT(*) AS accounts_opened, "
    "COUNT(f.customer_id) AS funded_customers, "
    + _pct("COUNT(f.customer_id)", "COUNT(*)", "account_to_funding_pct")
    + " FROM customers JOIN accounts USING (customer_id) LEFT JOIN funded f USING (customer_id) "
    "GROUP BY 1",
    "q05_signup_to_funding": "SELECT *, "
    + _pct("funded_customers", "signups", "signup_to_funding_pct")
    + " FROM conversion",
    "q06_cac": "SELECT acquisition_channel, signups AS customers_acquired, "
    "CAST(spend AS DOUBLE) AS total_spend_gbp, [[money spend | signups | 2]] AS cac_gbp "
    "FROM conversion JOIN spend USING (acquisition_channel)",
    "q07_cost_per_funded": "SELECT acquisition_channel, funded_customers, "
    "CAST(spend AS DOUBLE) AS total_spend_gbp, "
    "[[money spend | funded_customers | 2]] AS cost_per_funded_customer_gbp "
    "FROM conversion JOIN spend USING (acquisition_channel)",
    "q08_d30_by_channel": "SELECT acquisition_channel, COUNT(*) AS eligible_customers, "
    "COUNT(*) FILTER (w1 >= 2) AS retained_d30, "
    + _pct("COUNT(*) FILTER (w1 >= 2)", "COUNT(*)", "d30_retention_pct")
    + " FROM windows WHERE funded_ts <= TIMESTAMP '2001-11-05' - INTERVAL 360 DAYS GROUP BY 1",
    "q09_avg_volume": "SELECT acquisition_channel, COUNT(*) AS funded_customers, "
    + _mean("volume", "avg_transaction_volume_gbp")
    + " FROM holders WHERE done > 0 GROUP BY 1",
    "q10_avg_frequency": "SELECT acquisition_channel, COUNT(*) AS funded_customers, "
    + _mean("done", "avg_completed_transactions", "count")
    + " FROM holders WHERE done > 0 GROUP BY 1",
    "q11_revenue_by_type": "SELECT transaction_type, completed_transactions, "
    "revenue_gbp AS total_revenue_gbp FROM transaction_economics",
    "q12_margin_by_type": "SELECT transaction_type, contribution_margin_gbp "
    "FROM transaction_economics",
    "q13_unit_margin": "SELECT transaction_type, completed_transactions, "
    "avg_margin_per_transaction_gbp FROM transaction_economics",
    "q14_fx_vs_non": "SELECT CASE WHEN used_fx THEN 'FX user' ELSE 'Non-FX user' END "
    "AS customer_segment, COUNT(*) AS customers, "
    + ", ".join(
        (
            _mean("done", "avg_completed_transactions", "count"),
            _mean("volume", "avg_transaction_volume_gbp"),
            _mean("margin", "avg_contribution_margin_gbp"),
        )
    )
    + " FROM holders GROUP BY 1",
    "q15_fx_retention": "SELECT * FROM fx_retention",
    "q16_fx_share": "SELECT acquisition_channel, COUNT(*) AS funded_customers, "
    "COUNT(*) FILTER (used_fx) AS fx_users, "
    + _pct("COUNT(*) FILTER (used_fx)", "COUNT(*)", "fx_user_pct")
    + " FROM holders GROUP BY 1",
    "q17_avg_margin_channel": "SELECT acquisition_channel, COUNT(*) AS funded_customers, "
    + _mean("margin_any", "avg_contribution_margin_gbp")
    + " FROM holders GROUP BY 1",
    "q18_total_margin_channel": "SELECT acquisition_channel, "
    "CAST(SUM(margin_any) AS DOUBLE) AS total_contribution_margin_gbp FROM holders GROUP BY 1",
    "q19_net_contribution": "SELECT acquisition_channel, CAST(m AS DOUBLE) AS total_margin_gbp, "
    "CAST(spend AS DOUBLE) AS acquisition_spend_gbp, "
    "CAST(m - spend AS DOUBLE) AS net_contribution_after_acquisition_gbp "
    "FROM (SELECT acquisition_channel, SUM(margin_any) AS m FROM holders GROUP BY 1) "
    "JOIN spend USING (acquisition_channel)",
    "v_channel_performance": "SELECT * FROM channel_performance",
    "v_dashboard_kpis": "SELECT * FROM kpis",
    "v_experiment_performance": "SELECT * FROM experiment_performance",
    "v_fx_customer_segments": "SELECT * FROM fx_customer_segments",
    "v_fx_retention": "SELECT * FROM fx_retention",
    "v_retention_cohorts": "SELECT * FROM retention_cohorts",
    "v_transaction_economics": "SELECT * FROM transaction_economics",
    "exp_summary": "SELECT variant, CAST(SUM(assigned) AS BIGINT) AS assigned_customers, "
    "CAST(SUM(hits) AS BIGINT) AS activated_customers, "
    "CAST(SUM(cost) AS DOUBLE) AS total_incentive_cost_gbp, "
    "COALESCE(CAST(SUM(margin_sum) AS DOUBLE) / NULLIF(SUM(margin_n), 0), 0) "
    "AS avg_margin_before_incentive_gbp FROM arms GROUP BY 1",
    "exp_ztest": _readout("", _TEST),
    "exp_economics": _readout("", _ECONOMICS),
    "exp_decision": _readout("", f"{_R('lift')}, {_R('p_value')}, {_DECISION}"),
    "exp_by_dim": _readout(
        "experiment_name, acquisition_channel", f"{_TEST}, {_ECONOMICS}, {_DECISION}"
    ),
    "ev_lifecycle": f"SELECT {_EVENT} FROM product_events "
    "WHERE event_name NOT IN ('first_funding', 'first_transaction')",
    "ev_first_funding": f"SELECT {_EVENT} FROM product_events WHERE event_name = 'first_funding'",
    "ev_first_transaction": f"SELECT {_EVENT} FROM product_events "
    "WHERE event_name = 'first_transaction'",
    "ev_refresh": f"SELECT {_EVENT} FROM product_events",
    "tx_amount_median": """
      SELECT transaction_type, day, CAST(SUM(pence) AS DOUBLE) / (100 * COUNT(*)) AS median_amount_gbp
      FROM (SELECT *, row_number() OVER (PARTITION BY transaction_type, day ORDER BY pence) AS n,
                   COUNT(*) OVER (PARTITION BY transaction_type, day) AS total
            FROM (SELECT transaction_type, CAST(transaction_ts AS DATE) AS day,
                         CAST(amount_gbp * 100 AS BIGINT) AS pence FROM transactions))
      WHERE n IN ((total + 1) // 2, total // 2 + 1) GROUP BY 1, 2""",
    "tx_economics": f"SELECT {_ID}, transaction_type, status, "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}"
        for c in (
            "amount_gbp",
            "fee_revenue_gbp",
            "interchange_revenue_gbp",
            "fx_spread_revenue_gbp",
            "processing_cost_gbp",
        )
    )
    + " FROM transactions",
    "tx_incentive": f"SELECT {_ID}, account_id, transaction_ts, "
    "CAST(incentive_cost_gbp AS DOUBLE) AS incentive_cost_gbp FROM incentives "
    "WHERE incentive_cost_gbp > 0",
    "tx_subtypes": """
      SELECT transaction_type, CAST(COUNT(m) AS BIGINT) AS transactions,
             CAST(COUNT(d) AS BIGINT) AS detail_rows, COUNT(*) FILTER (d IS NULL) AS without_detail,
             COUNT(*) FILTER (m IS NULL) AS without_transaction
      FROM (SELECT transaction_id, transaction_type, transaction_id AS m FROM transactions
            WHERE transaction_type IN ('card_payment', 'bank_transfer', 'fx_exchange'))
      FULL JOIN (SELECT transaction_id, 'card_payment' AS transaction_type, transaction_id AS d
                 FROM card_transactions
                 UNION ALL SELECT transaction_id, 'bank_transfer', transaction_id FROM transfers
                 UNION ALL SELECT transaction_id, 'fx_exchange', transaction_id
                 FROM fx_transactions) USING (transaction_id, transaction_type)
      GROUP BY 1""",
    "tx_cards": f"SELECT {_ID}, * EXCLUDE (transaction_id) FROM card_transactions",
    "tx_transfers": f"SELECT {_ID}, * EXCLUDE (transaction_id) FROM transfers",
    "fx_quote": f"SELECT {_ID}, * EXCLUDE (transaction_id) FROM fx_transactions",
    "acct_tenure": "SELECT account_id, CAST(greatest(1, floor(epoch(TIMESTAMP '2001-11-05' "
    "- opened_ts) / 86400)) AS BIGINT) AS days_available FROM accounts",
    "val_row_counts": _union(
        [
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
            for t in list(_NOT_NULL)[:6]
        ]
    ),
    "val_kyc_status": "SELECT status, COUNT(*) AS customers FROM kyc_cases GROUP BY 1",
    "val_events": "SELECT event_name, COUNT(*) AS events FROM product_events GROUP BY 1",
    "val_signups": "SELECT acquisition_channel, COUNT(*) AS signups FROM customers GROUP BY 1",
    "val_variants": "SELECT variant, COUNT(*) AS assigned_customers "
    "FROM experiment_assignments GROUP BY 1",
    "dq_unique": _union(
        [
            _unique(t, columns)
            for t, columns in (
                ("customers", "customer_id"),
                ("kyc_cases", "kyc_case_id"),
                ("accounts", "account_id"),
                ("accounts", "customer_id"),
                ("marketing_spend", "spend_month,acquisition_channel"),
                ("experiment_assignments", "assignment_id"),
                ("experiment_assignments", "customer_id,experiment_name"),
                ("product_events", "event_id"),
                ("incentives", "transaction_id"),
                ("card_transactions", "transaction_id"),
                ("transfers", "transaction_id"),
                ("fx_transactions", "transaction_id"),
            )
        ]
    ).replace("'incentives'", "'transactions'"),
    "dq_not_null": _union(_not_null(_NOT_NULL)).replace("FROM transactions)", "FROM incentives)"),
    "dq_domain": _union(
        [
            _domain(
                "customers",
                "acquisition_channel",
                "automobile building furniture household machinery",
            ),
            _domain("customers", "device_os", "iOS Android"),
            _domain("kyc_cases", "status", "approved rejected abandoned"),
            _domain("accounts", "plan_tier", "standard premium"),
            _domain("accounts", "base_currency", "GBP EUR"),
            _domain("experiment_assignments", "variant", "control bonus_10"),
            _domain(
                "transactions",
                "transaction_type",
                "cash_in card_payment bank_transfer fx_exchange cash_withdrawal",
            ),
            _domain("transactions", "status", "completed failed reversed"),
            _domain("transfers", "direction", "inbound outbound"),
            _domain("transfers", "transfer_rail", "faster_payments sepa swift"),
        ]
    ),
    "dq_range": _union(
        [
            _bad_rows("range:age", "customers", "age < 18 OR age > 100"),
            _bad_rows("range:spend_gbp", "marketing_spend", "spend_gbp < 0"),
            _bad_rows("range:impressions", "marketing_spend", "impressions < 0"),
            _bad_rows("range:clicks", "marketing_spend", "clicks < 0"),
            _bad_rows("range:amount_gbp", "transactions", "amount_gbp < 0"),
        ]
    ),
    "dq_fk": _union(
        [
            _orphans("kyc_cases", "customer_id", "customers", "customer_id"),
            _orphans("accounts", "customer_id", "customers", "customer_id"),
            _orphans("experiment_assignments", "customer_id", "customers", "customer_id"),
            _orphans("product_events", "customer_id", "customers", "customer_id"),
            _orphans("transactions", "account_id", "accounts", "account_id"),
            _orphans("card_transactions", "transaction_id", "transactions", "transaction_id"),
            _orphans("transfers", "transaction_id", "transactions", "transaction_id"),
            _orphans("fx_transactions", "transaction_id", "transactions", "transaction_id"),
        ]
    ),
    "dq_contract": _union(_CONTRACTS),
    "dash_headline": "SELECT format('{:,}', total_signups) AS signups, "
    "format('{:,}', funded_customers) AS funded_customers, "
    "format('{:,}', total_transactions) AS transactions, "
    "printf('£%.1fM', round(completed_transaction_volume_gbp / 1000000, 1)) AS completed_volume, "
    "printf('%.1f%%', CAST(funded_customers AS DOUBLE) / total_signups * 100) AS signup_to_funding, "
    "format('{:,}', kyc_approved) AS kyc_approved, "
    "format('{:,}', transacting_customers) AS transacting_customers, "
    "'£' || format('{:,}', CAST(round_even(total_contribution_margin_gbp, 0) AS BIGINT)) "
    "AS contribution_margin FROM kpis",
    "dash_channels": _CHANNEL_TABLE,
    "dash_channels_by_conversion": f"SELECT {_label('acquisition_channel')} AS channel, "
    "signup_to_funding_pct FROM channel_performance",
    "dash_channels_by_cost": f"SELECT {_label('acquisition_channel')} AS channel, "
    "cost_per_funded_customer_gbp FROM channel_performance",
    "dash_retention_long": "SELECT strftime(funding_cohort, '%b %Y') AS cohort, 'D30' AS metric, "
    "d30_retention_pct AS retention_pct FROM retention_cohorts UNION ALL "
    "SELECT strftime(funding_cohort, '%b %Y'), 'D60', d60_retention_pct FROM retention_cohorts",
    "dash_variant_labels": "SELECT variant, CASE variant WHEN 'bonus_10' THEN '£10 bonus' "
    "WHEN 'control' THEN 'Control' END AS variant_label, activation_rate_pct, "
    "avg_margin_after_incentive_gbp FROM experiment_performance",
    "dash_fx_delta": "SELECT "
    "round(f.avg_completed_transactions - n.avg_completed_transactions, 2) "
    "AS completed_transactions_delta, "
    "round(f.avg_transaction_volume_gbp - n.avg_transaction_volume_gbp, 2) "
    "AS transaction_volume_delta_gbp, "
    "round(rf.d30_retention_pct - rn.d30_retention_pct, 2) AS d30_retention_delta_pp "
    "FROM fx_customer_segments f, fx_customer_segments n, fx_retention rf, fx_retention rn "
    "WHERE f.customer_segment = 'FX user' AND n.customer_segment = 'Non-FX user' "
    "AND rf.customer_segment = 'FX user' AND rn.customer_segment = 'Non-FX user'",
    "dash_economics": _ECONOMICS_TABLE,
    "dash_economics_by_margin": f"SELECT {_label('transaction_type')} AS transaction_label, "
    "contribution_margin_gbp FROM transaction_economics",
    "src_csv": "SELECT * FROM customers JOIN kyc_cases USING (customer_id)",
    "src_columns": "SELECT customer_id, age FROM customers",
    "src_extracts": "SELECT * FROM channel_performance",
    "sink_extracts": _union(
        [
            f"SELECT '{view}' AS table_name, COUNT(*) AS row_count FROM {view}"
            for view in (
                "kpis",
                "channel_performance",
                "retention_cohorts",
                "experiment_performance",
                "fx_customer_segments",
                "fx_retention",
                "transaction_economics",
            )
        ]
    ),
    "sink_views": "SELECT * FROM transaction_economics",
    "sink_publish": "SELECT * FROM accounts",
    "sink_refresh": f"SELECT {_EVENT} FROM product_events",
    "dq_defaults": f"SELECT {_ID}, fee_revenue_gbp::DOUBLE AS fee_revenue_gbp, "
    "interchange_revenue_gbp::DOUBLE AS interchange_revenue_gbp, "
    "fx_spread_revenue_gbp::DOUBLE AS fx_spread_revenue_gbp, "
    "processing_cost_gbp::DOUBLE AS processing_cost_gbp, 0.0::DOUBLE AS incentive_cost_gbp "
    "FROM transactions",
}

LEDGER_QUERIES = {
    "ledger_validate": """
      SELECT request_id, session_id, idempotency_key, ts, source_account_id,
             destination_account_id, amount_minor, reason,
             CASE WHEN reason IS NULL THEN 'GBP' END AS currency
      FROM (SELECT *, CASE
              WHEN NOT regexp_full_match(idempotency_key, '[A-Za-z0-9._:-]{1,128}')
                THEN 'idempotency_key'
              WHEN doc IS NULL OR json_type(doc) <> 'OBJECT' THEN 'malformed_body'
              WHEN len(list_filter(json_keys(doc), lambda f: f NOT IN ('source_account_id',
                   'destination_account_id', 'amount_minor', 'currency'))) > 0
                THEN 'unknown_field'
              WHEN source_account_id IS NULL THEN 'source_account_id'
              WHEN destination_account_id IS NULL THEN 'destination_account_id'
              WHEN amount_minor IS NULL OR amount_minor < 1 OR amount_minor > 1000000000000
                THEN 'amount_minor'
              WHEN currency_kind IS NOT NULL
                   AND COALESCE(json_extract_string(doc, '$.currency'), '') <> 'GBP'
                THEN 'currency'
              WHEN source_account_id = destination_account_id THEN 'same_account'
            END AS reason FROM canonical)""",
    "ledger_validate_accounts": """
      SELECT request_id, session_id, ts, owner_name, opening_balance_minor, reason,
             CASE WHEN reason IS NULL THEN 'GBP' END AS currency
      FROM (SELECT *, CASE
              WHEN json_type(body) <> 'OBJECT' THEN 'malformed_body'
              WHEN len(list_filter(json_keys(body), lambda f: f NOT IN ('owner_name', 'currency',
                   'opening_balance_minor'))) > 0 THEN 'unknown_field'
              WHEN owner_name IS NULL OR length(owner_name) NOT BETWEEN 1 AND 100
                THEN 'owner_name'
              WHEN json_type(body, '$.currency') IS NOT NULL
                   AND json_extract_string(body, '$.currency') <> 'GBP' THEN 'currency'
              WHEN opening_balance_minor IS NULL
                   OR opening_balance_minor NOT BETWEEN 0 AND 1000000000000
                THEN 'opening_balance_minor'
            END AS reason
            FROM (SELECT *, trim(json_extract_string(body, '$.owner_name')) AS owner_name,
                         CASE WHEN json_type(body, '$.opening_balance_minor') IS NULL THEN 0
                              WHEN json_type(body, '$.opening_balance_minor')
                                   IN ('UBIGINT', 'BIGINT')
                              THEN CAST(json_extract_string(body, '$.opening_balance_minor')
                                        AS BIGINT) END AS opening_balance_minor
                  FROM account_bodies))""",
    "ledger_idempotency": """
      SELECT v.request_id, v.session_id, v.idempotency_key, v.amount_minor,
             CASE WHEN j.request_id IS NULL OR (v.ts, v.request_id) < (j.created_at, j.request_id)
                    THEN 'rejected'
                  WHEN v.request_id = j.request_id THEN 'committed'
                  WHEN v.source_account_id = j.source_account_id
                   AND v.destination_account_id = j.destination_account_id
                   AND v.amount_minor = j.amount_minor THEN 'replayed'
                  ELSE 'conflict' END AS outcome
      FROM valid v
      LEFT JOIN journal j
        ON j.idempotency_key = sha256(v.session_id || ':' || v.idempotency_key)""",
    "ledger_journal": "SELECT * FROM journal",
    "ledger_postings": "SELECT * FROM postings",
    "ledger_balances": """
      SELECT account_id, opening_balance_minor,
             CAST(opening_balance_minor + COALESCE(m, 0) AS DOUBLE) AS computed_balance_minor,
             balance_minor,
             CAST(balance_minor - opening_balance_minor - COALESCE(m, 0) AS DOUBLE) AS drift_minor
      FROM ledger_accounts
      LEFT JOIN (SELECT account_id, SUM(signed_minor) AS m FROM postings GROUP BY 1)
        USING (account_id)""",
    "ledger_conservation": """
      SELECT CAST(o AS DOUBLE) AS opening_minor, CAST(o + p AS DOUBLE) AS computed_minor,
             p = 0 AS conserved
      FROM (SELECT SUM(opening_balance_minor) AS o FROM ledger_accounts),
           (SELECT COALESCE(SUM(signed_minor), 0) AS p FROM postings
            WHERE account_id IN (SELECT account_id FROM ledger_accounts))""",
    "ledger_running": "SELECT *, balance_after_minor < 0 AS overdrawn, "
    "balance_after_minor > 9000000000000000 AS over_limit FROM running",
    "ledger_overdrafts": "SELECT account_id, COUNT(*) AS postings, "
    "COUNT(*) FILTER (balance_after_minor < 0) AS overdrawn_postings, "
    "COUNT(*) FILTER (balance_after_minor > 9000000000000000) AS over_limit_postings, "
    "MIN(balance_after_minor) AS lowest_balance_minor FROM running GROUP BY 1",
    "ledger_quota_accounts": "SELECT account_id, session_id, created_at, n <= 5 AS accepted, "
    "CAST(CASE WHEN n <= 5 THEN 201 ELSE 429 END AS INTEGER) AS status_code "
    "FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY created_at, account_id) "
    "AS n FROM ledger_accounts)",
    "ledger_quota_transfers": "SELECT request_id, session_id, created_at, n <= 100 AS accepted, "
    "CAST(CASE WHEN n <= 100 THEN 201 ELSE 429 END AS INTEGER) AS status_code "
    "FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY created_at, request_id) "
    "AS n FROM journal)",
    "ledger_history": "SELECT * EXCLUDE (n), CAST(n AS INTEGER) AS position FROM (SELECT *, row_number() OVER "
    "(PARTITION BY account_id ORDER BY created_at DESC, transfer_id DESC) AS n FROM postings) "
    "WHERE n > 5 AND n <= 25",
    "ledger_history_deep": "SELECT * EXCLUDE (n), CAST(n AS INTEGER) AS position FROM (SELECT *, row_number() "
    "OVER (PARTITION BY account_id ORDER BY created_at DESC, transfer_id DESC) AS n "
    "FROM postings) WHERE n > 50 AND n <= 150",
    "ledger_rate_limit": """
      SELECT session_id, request_id,
             CASE WHEN alive THEN row_number() OVER (PARTITION BY session_id, alive, opened
                                                     ORDER BY ts, request_id) <= 3 END AS passed
      FROM (SELECT CAST(e.user_id AS VARCHAR) AS session_id, e.event_id AS request_id, e.ts,
                   (SELECT MAX(c.opened) FROM chain c
                    WHERE c.user_id = e.user_id AND c.opened <= e.ts) AS opened,
                   e.ts < u.created_at + INTERVAL 10 DAYS AS alive
            FROM evt e JOIN users u USING (user_id))""",
    "ledger_session_expiry": """
      SELECT 'sessions' AS table_name, COUNT(*) AS row_count,
             COUNT(*) FILTER (expires_at > TIMESTAMP '2024-01-01 07:00:00') AS kept
      FROM user_sessions
      UNION ALL
      SELECT 'accounts', COUNT(*), COUNT(*) FILTER (NOT dead) FROM owned
      UNION ALL
      SELECT 'transfers', COUNT(*), COUNT(*) FILTER (NOT COALESCE(o.dead, FALSE))
      FROM ledger_transfers t LEFT JOIN owned o ON o.account_id = t.source_account_id""",
    "ledger_admission": """
      SELECT alive, recent, alive >= 25 OR recent >= 3 AS busy FROM (
        SELECT COUNT(*) AS alive,
               COUNT(*) FILTER (created_at > TIMESTAMP '2024-01-01 06:59:00') AS recent
        FROM user_sessions
        WHERE created_at <= TIMESTAMP '2024-01-01 07:00:00'
          AND expires_at > TIMESTAMP '2024-01-01 07:00:00')""",
    "ledger_admission_timeline": """
      SELECT window_start, window_end, new_sessions, alive, alive >= 20 OR new_sessions >= 5 AS busy
      FROM (SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, COUNT(*) AS new_sessions
            FROM (SELECT unnest([time_bucket(INTERVAL 10 MINUTES, created_at)
                                 - i * INTERVAL 10 MINUTES for i in range(6)]) AS w
                  FROM user_sessions) GROUP BY 1),
        LATERAL (SELECT COUNT(*) AS alive FROM user_sessions
                 WHERE created_at <= window_end AND expires_at > window_end)""",
    "ledger_visibility": """
      SELECT account_id, request_id, session_id,
             CAST(CASE WHEN a_id IS NOT NULL AND session_id IS NOT DISTINCT FROM owner
                       THEN 200 ELSE 404 END AS INTEGER) AS status_code
      FROM (SELECT e.event_id AS request_id,
                   CASE WHEN user_id % 10 <> 0 THEN CAST(user_id AS VARCHAR) END AS session_id,
                   '00000000-0000-4000-8000-'
                     || lpad(CAST(user_id + k % 2 * 10 AS VARCHAR), 12, '0') AS account_id
            FROM evt e)
      LEFT JOIN (SELECT account_id, account_id AS a_id, session_id AS owner FROM user_accounts)
        USING (account_id)""",
    "ledger_history_keyset": """
      SELECT transfer_id, created_at, account_id, signed_minor, direction
      FROM (SELECT CAST(CAST(md5(CAST(event_id AS VARCHAR)) AS UUID) AS VARCHAR) AS transfer_id,
                   TIMESTAMP '2026-01-01' + event_id * INTERVAL 1 SECOND AS created_at,
                   CAST(CAST(md5('42') AS UUID) AS VARCHAR) AS account_id,
                   CAST(CASE event_id % 1000 WHEN 42 THEN -100 ELSE 100 END AS BIGINT) AS signed_minor,
                   CASE event_id % 1000 WHEN 42 THEN 'outgoing' ELSE 'incoming' END AS direction
            FROM events WHERE event_id % 1000 IN (41, 42))
      ORDER BY created_at DESC, transfer_id DESC LIMIT 5 OFFSET 5""",
    "bench_transfers": """
      SELECT *, CASE WHEN source_account_id = CAST(CAST(md5('42') AS UUID) AS VARCHAR)
                     THEN 'outgoing' ELSE 'incoming' END AS direction
      FROM (SELECT CAST(CAST(md5(CAST(event_id AS VARCHAR)) AS UUID) AS VARCHAR) AS transfer_id,
                   CAST(CAST(md5(CAST(event_id % 1000 AS VARCHAR)) AS UUID) AS VARCHAR)
                     AS source_account_id,
                   CAST(CAST(md5(CAST((event_id + 1) % 1000 AS VARCHAR)) AS UUID) AS VARCHAR)
                     AS destination_account_id,
                   CAST(100 AS BIGINT) AS amount_minor, 'GBP' AS currency,
                   TIMESTAMP '2026-01-01' + event_id * INTERVAL 1 SECOND AS created_at
            FROM events)
      WHERE CAST(CAST(md5('42') AS UUID) AS VARCHAR) IN (source_account_id, destination_account_id)
      ORDER BY created_at DESC, transfer_id DESC LIMIT 20""",
    "dq_cross": _bad_rows(
        "differs:source_account_id,destination_account_id",
        "ledger_transfers",
        "source_account_id = destination_account_id",
    ),
    "dq_ledger": _union(
        [
            _unique("ledger_sessions", "session_id"),
            _unique("ledger_sessions", "token_hash"),
            _unique("ledger_accounts", "account_id"),
            _unique("ledger_transfers", "transfer_id"),
            _unique("ledger_transfers", "idempotency_key"),
            *_not_null(_LEDGER_NOT_NULL),
            _domain("ledger_accounts", "currency", "GBP"),
            _domain("ledger_transfers", "currency", "GBP"),
            _bad_rows(
                "range:opening_balance_minor",
                "ledger_accounts",
                "opening_balance_minor < 0 OR opening_balance_minor > 1000000000000",
            ),
            _bad_rows(
                "range:balance_minor",
                "ledger_accounts",
                "balance_minor < 0 OR balance_minor > 9000000000000000",
            ),
            _bad_rows(
                "length:owner_name", "ledger_accounts", "length(owner_name) NOT BETWEEN 1 AND 100"
            ),
            _bad_rows(
                "range:amount_minor",
                "ledger_transfers",
                "amount_minor < 1 OR amount_minor > 1000000000000",
            ),
            _bad_rows(
                "length:idempotency_key",
                "ledger_transfers",
                "length(idempotency_key) NOT BETWEEN 1 AND 128",
            ),
            _check(
                "foreign_key:session_id",
                "ledger_accounts",
                "SELECT COUNT(*) AS n FROM user_accounts a WHERE a.session_id IS NOT NULL "
                "AND a.session_id NOT IN (SELECT session_id FROM user_sessions)",
            ),
            _orphans("ledger_transfers", "source_account_id", "ledger_accounts", "account_id"),
            _orphans(
                "ledger_transfers", "destination_account_id", "ledger_accounts", "account_id"
            ),
        ]
    ),
}

# Streams publish a window or session once the watermark (30 minutes behind the latest event) is
# past it; what is still open then is not part of their output.
LEDGER_QUERIES |= {
    "stream_unique_requests": """
      SELECT sha256(key) AS scoped_key, arg_min(request_id, request_id) AS request_id
      FROM chain JOIN (SELECT session_id || ':' || idempotency_key AS key, ts, request_id FROM valid)
        USING (key)
      WHERE ts = opened GROUP BY key, opened""",
    "stream_rate_limit": LEDGER_QUERIES["ledger_rate_limit"],
    "stream_session_expiry": """
      SELECT session_id, CAST(NULL AS BIGINT) AS request_id, expires_at AS at, 'expired' AS outcome
      FROM user_sessions
      UNION ALL
      SELECT session_id, event_id, ts, 'refused'
      FROM evt JOIN user_sessions ON session_id = CAST(user_id AS VARCHAR) WHERE ts >= expires_at""",
    "stream_request_counts": "SELECT date_trunc('minute', ts) AS window_start, "
    "COUNT(*) AS requests, COUNT(*) FILTER (event_type = 'signup') AS new_sessions FROM evt "
    "GROUP BY 1 HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE "
    "<= (SELECT MAX(ts) - INTERVAL 30 MINUTES FROM evt)",
}
TENANT_QUERIES |= {
    "stream_daily_economics": """
      SELECT day, transaction_type,
             COUNT(*) FILTER (ok) AS completed_transactions,
             CAST(SUM(amount_gbp) FILTER (ok) AS DOUBLE) AS transaction_volume_gbp,
             CAST(SUM(revenue) FILTER (ok) AS DOUBLE) AS revenue_gbp,
             CAST(SUM(processing_cost_gbp) FILTER (ok) AS DOUBLE) AS processing_cost_gbp,
             CAST(SUM(margin) FILTER (ok) AS DOUBLE) AS contribution_margin_gbp,
             [[money SUM(margin) FILTER (ok) | COUNT(*) FILTER (ok) | 4]]
               AS avg_margin_per_transaction_gbp
      FROM (SELECT *, CAST(date_trunc('day', transaction_ts) AS TIMESTAMP) AS day FROM money)
      WHERE day + INTERVAL 1 DAY <= (SELECT MAX(l_shipdate) - INTERVAL 30 MINUTES FROM lineitem)
      GROUP BY 1, 2""",
    "stream_first_funding": f"SELECT account_id, transaction_ts, {_ID}, "
    "CAST(amount_gbp AS DOUBLE) AS amount_gbp FROM fundings",
    "stream_cohort_activity": "SELECT account_id, w1 AS events FROM windows WHERE w1 > 0",
}

LEDGER_QUERIES["ledger_outcomes"] = f"""
  SELECT k.request_id, k.session_id, CAST(status AS INTEGER) AS status_code,
         CASE WHEN status = 422 THEN reason END AS reason
  FROM (
    WITH checked AS ({LEDGER_QUERIES["ledger_validate"]}),
    groups AS (
      SELECT CAST(user_id // 50 AS VARCHAR) AS session_id,
             MIN(created_at) + INTERVAL 20 DAYS AS expires_at
      FROM users WHERE user_id // 50 % 7 <> 3 GROUP BY 1),
    alive AS (SELECT c.* FROM checked c JOIN groups g USING (session_id) WHERE c.ts < g.expires_at),
    tries AS (
      SELECT v.*, row_number() OVER (PARTITION BY v.session_id, idempotency_key
                                     ORDER BY ts, request_id) AS n
      FROM alive v
      JOIN ledger_accounts s ON s.account_id = source_account_id AND s.session_id = v.session_id
      JOIN ledger_accounts d ON d.account_id = destination_account_id
                            AND d.session_id = v.session_id
      WHERE reason IS NULL),
    commits AS (
      SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, request_id) AS c
      FROM tries WHERE n = 1)
    SELECT r.*, CASE
      WHEN g.session_id IS NULL OR r.ts >= g.expires_at THEN 401
      WHEN r.reason IS NOT NULL THEN 422
      WHEN b.request_id = r.request_id THEN 201
      WHEN (r.ts, r.request_id) > (b.ts, b.request_id)
        THEN CASE WHEN b.source_account_id = r.source_account_id
                   AND b.destination_account_id = r.destination_account_id
                   AND b.amount_minor = r.amount_minor THEN 200 ELSE 409 END
      WHEN (r.ts, r.request_id) > (f.ts, f.request_id) THEN 429
      ELSE 404 END AS status
    FROM checked r LEFT JOIN groups g USING (session_id)
    LEFT JOIN commits b ON b.c <= 20 AND b.session_id = r.session_id
                       AND b.idempotency_key = r.idempotency_key
    LEFT JOIN commits f ON f.c = 20 AND f.session_id = r.session_id) k"""

# One request of every session at a time, with the balances of its fifty users and its booked keys.
LEDGER_QUERIES["ledger_settlement"] = f"""
  SELECT k.request_id, k.session_id, CAST(status AS INTEGER) AS status_code,
         CASE status WHEN 401 THEN 'session_expired' WHEN 422 THEN reason WHEN 429 THEN 'transfer_limit'
              WHEN 404 THEN 'account_not_found' WHEN 409 THEN verdict END AS code
  FROM (
    WITH RECURSIVE checked AS MATERIALIZED ({LEDGER_QUERIES["ledger_validate"]}),
    groups AS (
      SELECT CAST(user_id // 50 AS VARCHAR) AS session_id,
             MIN(created_at) + INTERVAL 20 DAYS AS expires_at
      FROM users WHERE user_id // 50 % 7 <> 3 GROUP BY 1),
    tries AS MATERIALIZED (
      SELECT v.*, row_number() OVER (PARTITION BY v.session_id ORDER BY ts, request_id) AS n,
             CAST(right(v.source_account_id, 12) AS INT) % 50 AS payer,
             CAST(right(v.destination_account_id, 12) AS INT) % 50 AS payee,
             CAST(string_split(v.idempotency_key, ':')[2] AS INT) AS k
      FROM checked v JOIN groups g USING (session_id)
      JOIN ledger_accounts s ON s.account_id = source_account_id AND s.session_id = v.session_id
      JOIN ledger_accounts d ON d.account_id = destination_account_id
                            AND d.session_id = v.session_id
      WHERE v.ts < g.expires_at AND reason IS NULL),
    walk(session_id, n, balances, keys, used, request_id, verdict) AS (
      SELECT session_id, CAST(0 AS BIGINT), list_transform(range(50), lambda x: CAST(30000 AS BIGINT)),
             bitstring('0', 5000), 0, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM groups
      UNION ALL
      SELECT session_id, n,
             CASE verdict WHEN 'booked' THEN list_transform(balances, lambda b, i:
               b + CASE i WHEN payee + 1 THEN amount_minor WHEN payer + 1 THEN -amount_minor ELSE 0 END)
               ELSE balances END,
             CASE verdict WHEN 'booked' THEN set_bit(keys, payer * 100 + k, 1) ELSE keys END,
             used + CAST(verdict = 'booked' AS INT), request_id, verdict
      FROM (
        SELECT w.session_id, t.n, balances, keys, used, payer, payee, k, amount_minor, t.request_id,
               CASE WHEN get_bit(keys, payer * 100 + k) = 1 THEN 'key'
                    WHEN used >= 600 THEN 'quota'
                    WHEN balances[payer + 1] < amount_minor THEN 'insufficient_funds'
                    WHEN balances[payee + 1] + amount_minor > 60000 THEN 'balance_limit'
                    ELSE 'booked' END AS verdict
        FROM walk w JOIN tries t ON t.session_id = w.session_id AND t.n = w.n + 1)),
    booked AS (
      SELECT t.*, row_number() OVER (PARTITION BY t.session_id ORDER BY t.n) AS c
      FROM walk w JOIN tries t USING (request_id) WHERE verdict = 'booked')
    SELECT r.request_id, r.session_id, r.reason, CASE
      WHEN g.session_id IS NULL OR r.ts >= g.expires_at THEN 401
      WHEN r.reason IS NOT NULL THEN 422
      WHEN b.request_id = r.request_id THEN 201
      WHEN (r.ts, r.request_id) > (b.ts, b.request_id)
        THEN CASE WHEN b.source_account_id = r.source_account_id
                   AND b.destination_account_id = r.destination_account_id
                   AND b.amount_minor = r.amount_minor THEN 200 ELSE 409 END
      WHEN (r.ts, r.request_id) > (f.ts, f.request_id) THEN 429
      WHEN w.request_id IS NULL THEN 404
      ELSE 409 END AS status,
      CASE WHEN (r.ts, r.request_id) > (b.ts, b.request_id) THEN 'idempotency_conflict'
           ELSE w.verdict END AS verdict
    FROM checked r LEFT JOIN groups g USING (session_id)
    LEFT JOIN walk w ON w.request_id = r.request_id
    LEFT JOIN booked b ON b.session_id = r.session_id AND b.idempotency_key = r.idempotency_key
    LEFT JOIN booked f ON f.c = 600 AND f.session_id = r.session_id) k"""

# Extra tables only some ledger queries need; the chain of window starts is recursive.
_EXTRA = {
    "ledger_rate_limit": """,
chain(user_id, opened) AS (
  SELECT user_id, created_at FROM users
  UNION ALL
  SELECT c.user_id, MIN(e.ts) FROM chain c
  JOIN evt e ON e.user_id = c.user_id AND e.ts >= c.opened + INTERVAL 1 DAY
  GROUP BY c.user_id)
""",
    "ledger_session_expiry": """,
owned AS (
  SELECT a.*, COALESCE(s.expires_at <= TIMESTAMP '2024-01-01 07:00:00', FALSE) AS dead
  FROM user_accounts a LEFT JOIN user_sessions s USING (session_id))
""",
}


_EXTRA["stream_rate_limit"] = _EXTRA["ledger_rate_limit"]
# A key's retry windows: each opens with the first request two days or more after the last one opened.
_EXTRA["stream_unique_requests"] = """,
chain(key, opened) AS (
  SELECT session_id || ':' || idempotency_key, MIN(ts) FROM valid GROUP BY 1
  UNION ALL
  SELECT c.key, MIN(v.ts) FROM chain c
  JOIN valid v ON v.session_id || ':' || v.idempotency_key = c.key AND v.ts >= c.opened + INTERVAL 2 DAYS
  GROUP BY c.key, c.opened)
"""


def oracle_sql() -> dict[str, str]:
    found = {name: f"WITH {TENANT} {sql}" for name, sql in TENANT_QUERIES.items()}
    for name, sql in LEDGER_QUERIES.items():
        recursive = "RECURSIVE " if "chain(" in _EXTRA.get(name, "") else ""
        found[name] = f"WITH {recursive}{LEDGER}{_EXTRA.get(name, '')} {sql}"
    return {name: _quotients(sql) for name, sql in found.items()}
