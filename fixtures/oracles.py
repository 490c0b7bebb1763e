"""DuckDB statements for the registered queries, written from the fixture mapping.

They never look at JSON: what a message must lead to follows from the typed
row and from ``event_id % 50``, the fault code.
"""

from __future__ import annotations

# Typed payments, one row per event and copy.
_TYPED = """
keyed AS (
  SELECT e.event_id AS e, e.user_id AS u, e.event_type, e.value,
         CAST(c.c_nationkey % 5 AS INTEGER) AS home_key,
         CAST((c.c_nationkey + CASE WHEN e.event_id % 6 = 0 THEN 1 + e.event_id % 4 ELSE 0 END) % 5 AS INTEGER) AS txn_key
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
),
copied AS (
  SELECT keyed.*, 0 AS copy FROM keyed
  UNION ALL
  SELECT keyed.*, 1 AS copy FROM keyed WHERE e % 20 = 0
),
timed AS (
  SELECT copied.*, h.n_name AS home_name, t.n_name AS txn_name,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(
           (e % 3) * 86400 + CASE WHEN e % 23 < 12 THEN 0 ELSE 3600 END + (e * 37) % 600
           + CASE WHEN copy = 0 THEN 0 WHEN e % 40 = 0 THEN 3 ELSE 45 END AS BIGINT)) AS transaction_ts,
         CAST(CASE e % 40 WHEN 1 THEN 400 WHEN 21 THEN 300 WHEN 31 THEN 301 ELSE e % 10 END AS BIGINT) AS delay
  FROM copied
  JOIN nation h ON h.n_nationkey = home_key
  JOIN nation t ON t.n_nationkey = txn_key
),
sent AS (
  SELECT e, copy, e % 50 AS fault,
         transaction_ts + to_seconds(delay) AS publish_ts,
         transaction_ts, delay,
         'TXN-' || lpad(CAST(e AS VARCHAR), 12, '0') AS transaction_id,
         'CUST-' || u AS customer_id,
         'CARD-' || (u * 3 + e % 3) AS card_id,
         'MER-' || (1000 + (e * 7919) % 13) AS merchant_id,
         CASE WHEN e % 500 = 250 THEN 'luxury' ELSE
           ['grocery', 'electronics', 'travel', 'gaming', 'luxury', 'fuel', 'gift_cards'][CAST((e * 31) % 7 AS INTEGER) + 1]
         END AS merchant_category,
         CASE WHEN e % 500 = 250 THEN 2000.0 ELSE CAST(CAST(value * 10 AS DECIMAL(18, 2)) AS DOUBLE) END AS amount,
         CASE WHEN e % 500 = 150 THEN lower(txn_name) ELSE home_name END AS sent_home,
         CASE WHEN e % 500 = 250 THEN home_name || 'X' ELSE txn_name END AS sent_txn,
         'City-' || txn_key AS city,
         'DEV-' || (u * 5 + e % 5) AS device_id,
         ['VISA', 'MASTERCARD', 'AMEX'][CAST(e % 3 AS INTEGER) + 1] AS payment_method,
         CASE WHEN e % 500 = 250 OR event_type = 'error' THEN 'DECLINED' ELSE 'APPROVED' END AS txn_status,
         e % 500 <> 250 AND (e * 7) % 11 >= 4 AS is_card_present,
         e % 500 = 250 OR e % 17 < 3 AS is_new_device,
         e % 11 = 0 OR value >= 150 AS simulated_fraud_label
  FROM timed
)
"""

# Scored payments from a relation with the columns of "sent".
_SCORED = """
scored AS (
  SELECT *, upper(sent_home) AS home_country, upper(sent_txn) AS txn_country,
         CAST(transaction_ts AS DATE) AS transaction_date,
         (CASE WHEN amount >= 1500 THEN 40 WHEN amount >= 800 THEN 20 ELSE 0 END
          + CASE WHEN sent_home <> sent_txn THEN 25 ELSE 0 END
          + CASE WHEN NOT is_card_present THEN 10 ELSE 0 END
          + CASE WHEN is_new_device THEN 15 ELSE 0 END
          + CASE WHEN upper(merchant_category) IN ('ELECTRONICS', 'LUXURY', 'GIFT_CARDS', 'TRAVEL') THEN 10 ELSE 0 END
          + CASE WHEN txn_status = 'DECLINED' THEN 5 ELSE 0 END) AS risk_score,
         concat_ws(',',
           CASE WHEN amount >= 1500 THEN 'HIGH_AMOUNT' WHEN amount >= 800 THEN 'ELEVATED_AMOUNT' END,
           CASE WHEN sent_home <> sent_txn THEN 'CROSS_BORDER' END,
           CASE WHEN NOT is_card_present THEN 'CARD_NOT_PRESENT' END,
           CASE WHEN is_new_device THEN 'NEW_DEVICE' END,
           CASE WHEN upper(merchant_category) IN ('ELECTRONICS', 'LUXURY', 'GIFT_CARDS', 'TRAVEL') THEN 'RISKY_MERCHANT_CATEGORY' END,
           CASE WHEN txn_status = 'DECLINED' THEN 'DECLINED_TRANSACTION' END) AS risk_reasons
  FROM {source}
),
payments AS (
  SELECT *, CASE WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM scored
)
"""

def _errors(raw: bool) -> str:
    """Error texts of a row, on the normalised path or on the values as sent.

    Some events have the value zero, so a row without a fault may have a bad amount.
    """
    missing = "Missing required fields: device_id" if raw else "''device_id''"
    pending = "pending" if raw else "PENDING"
    # Code 9 sends 0.004, which only rounding turns into zero.
    small = "fault <> 9 AND" if raw else "fault = 9 OR"
    return f"""CASE fault
         WHEN 13 THEN 'malformed JSON'
         WHEN 17 THEN '{missing}'
         WHEN 19 THEN 'The Pub/Sub message must be a JSON object.'
         WHEN 41 THEN 'amount must be numeric'
         ELSE concat_ws('; ',
           CASE WHEN {small} (fault = 7 OR amount <= 0) THEN 'amount must be greater than zero' END,
           CASE WHEN fault IN (11, 37) THEN 'currency must be a 3-letter code' END,
           CASE WHEN fault IN (23, 37) THEN 'Unsupported txn_status: {pending}' END,
           CASE WHEN fault = 31 THEN 'transaction_ts cannot be in the future' END,
           CASE WHEN fault = 29 THEN 'merchant_id cannot be empty' END,
           CASE WHEN fault = 43 THEN 'txn_country cannot be empty' END) END"""


# Messages without an error; code 47 only turns the card flag true.
_ACCEPTED = f"""
accepted AS (
  SELECT * REPLACE (is_card_present OR fault = 47 AS is_card_present)
  FROM sent WHERE {_errors(raw=False)} = ''
)
"""

# Those and the messages that only the currency keeps out.
_MENDED = _ACCEPTED.replace("= ''", "IN ('', 'currency must be a 3-letter code')")

_MINUTE = """
bronze AS (
  SELECT *, date_trunc('minute', publish_ts) AS minute FROM payments
  QUALIFY row_number() OVER (
    PARTITION BY date_trunc('minute', publish_ts), transaction_id ORDER BY transaction_ts, publish_ts) = 1
)
"""

# Minutes that the watermark has passed at the end, by the last publish time less the allowed lateness.
_PUBLISHED = """
published AS (
  SELECT * FROM bronze
  WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(publish_ts) FROM payments) - INTERVAL 300 SECOND
)
"""

_SILVER = """
silver AS (
  SELECT *,
         coalesce(txn_country <> home_country, FALSE) AS is_cross_border,
         coalesce(txn_status = 'DECLINED', FALSE) AS is_declined,
         coalesce(risk_score >= 80, FALSE) AS requires_manual_review
  FROM {source}
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_ts DESC) = 1
)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


TYPED = _with(_TYPED, _SCORED.format(source="sent"))
TYPED_MINUTE = _with(_TYPED, _SCORED.format(source="sent"), _MINUTE)
TYPED_SILVER = _with(_TYPED, _SCORED.format(source="sent"), _SILVER.format(source="payments"))
MESSAGES = _with(_TYPED, _ACCEPTED, _SCORED.format(source="accepted"))
MESSAGES_MINUTE = _with(_TYPED, _ACCEPTED, _SCORED.format(source="accepted"), _MINUTE)
MESSAGES_PUBLISHED = _with(_TYPED, _ACCEPTED, _SCORED.format(source="accepted"), _MINUTE, _PUBLISHED)
MESSAGES_SILVER = _with(
    _TYPED, _ACCEPTED, _SCORED.format(source="accepted"), _MINUTE, _SILVER.format(source="bronze")
)

_STAMP = "'%Y-%m-%d %H:%M:%S'"


def _stamp(name: str, alias: str | None = None) -> str:
    return f"strftime({name}, {_STAMP}) AS {alias or name}"


_DAY = "CAST(transaction_date AS VARCHAR) AS transaction_date"
_SCORE = "CAST(risk_score AS INTEGER) AS risk_score"

_BRONZE_COLUMNS = f"""
  transaction_id, customer_id, card_id, merchant_id, lower(merchant_category) AS merchant_category,
  amount, 'USD' AS currency, home_country, txn_country, city, device_id, payment_method,
  {_stamp('transaction_ts')}, {_DAY}, txn_status, is_card_present, is_new_device, simulated_fraud_label,
  {_SCORE}, risk_level, risk_reasons, 'fixture' AS ingest_source,
  {_stamp('publish_ts', 'processing_ts')}, delay > 300 AS is_late_arrival
"""

_SILVER_COLUMNS = f"""
  transaction_id, customer_id, card_id, merchant_id, merchant_category, amount, 'USD' AS currency,
  home_country, txn_country, city, device_id, payment_method, {_stamp('transaction_ts')}, {_DAY},
  txn_status, is_card_present, is_new_device, simulated_fraud_label, {_SCORE}, risk_level, risk_reasons,
  is_cross_border, is_declined, requires_manual_review, {_stamp('publish_ts', 'processing_ts')}
"""

_ALERTS = f"""
SELECT transaction_id, {_stamp('transaction_ts')}, customer_id, merchant_id, merchant_category, amount,
       txn_country, txn_status, {_SCORE}, risk_level, risk_reasons,
       '2024-02-01 00:00:00' AS alert_created_ts
FROM bronze WHERE risk_level = 'HIGH'
"""


def _metrics(extra: str = "") -> str:
    return f"""
SELECT {_stamp('minute', 'window_start')}, {_stamp("minute + INTERVAL 1 MINUTE", 'window_end')},
       txn_country, merchant_category, count(*) AS total_transactions,
       CAST(sum(CASE WHEN txn_status = 'APPROVED' THEN CAST(amount AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE) AS approved_amount,
       CAST(count_if(txn_status = 'DECLINED') AS BIGINT) AS declined_transactions,
       CAST(count_if(risk_level = 'HIGH') AS BIGINT) AS high_risk_transactions,
       CAST(count_if(simulated_fraud_label) AS BIGINT) AS simulated_fraud_transactions,
       round_even(CAST(sum(risk_score) AS DOUBLE) / count(*), 2) AS avg_risk_score,
       '2024-02-01 00:00:00' AS pipeline_run_ts{extra}
FROM bronze GROUP BY minute, txn_country, merchant_category
"""


_SHARE = """,
       CASE WHEN sum(CAST(amount AS DECIMAL(18, 2))) = 0 THEN NULL ELSE
         CAST(sum(CASE WHEN risk_level = 'HIGH' THEN CAST(amount AS DECIMAL(18, 2)) ELSE 0 END) AS DOUBLE)
         / CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) END AS suspicious_amount_share"""

_MEASURES = """count(*) AS total_transactions,
       CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS {amount},
       CAST(count_if(risk_level = 'HIGH') AS BIGINT) AS high_risk_transactions,
       CAST(count_if(txn_status = 'DECLINED') AS BIGINT) AS declined_transactions,
       CAST(count_if(simulated_fraud_label) AS BIGINT) AS simulated_fraud_transactions,
       round(CAST(sum(risk_score) AS DOUBLE) / count(*), 2) AS avg_risk_score,
       round(CAST(count_if(risk_level = 'HIGH') AS DOUBLE) / count(*) * 100, 2) AS high_risk_pct"""

_MERCHANTS = f"""
SELECT {_stamp("date_trunc('hour', transaction_ts)", 'window_hour')}, merchant_id, merchant_category,
       {_MEASURES.format(amount='gross_amount')}
FROM silver GROUP BY date_trunc('hour', transaction_ts), merchant_id, merchant_category
"""

_HOTSPOTS = f"""
SELECT {_DAY}, txn_country, {_MEASURES.format(amount='total_amount')},
       round(CAST(count_if(txn_status = 'DECLINED') AS DOUBLE) / count(*) * 100, 2) AS decline_pct
FROM silver GROUP BY silver.transaction_date, txn_country
"""


def _audit(relation: str, extras: bool = False) -> str:
    def check(name: str, failed: str, bad: str, details: str) -> str:
        return f"""
SELECT '2024-02-01' AS run_date, '{name}' AS check_name,
       CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END AS status, CAST(n AS BIGINT) AS failed_rows,
       '{details}' AS details, '2024-02-01 00:00:00' AS created_ts
FROM ({failed})"""

    rows = [
        check(
            "null_transaction_id_in_silver",
            f"SELECT count(*) AS n FROM {relation} WHERE transaction_id IS NULL",
            "FAIL",
            "transactions_curated should not contain null transaction_id values.",
        ),
        check(
            "duplicate_transaction_id_in_silver",
            f"SELECT count(*) AS n FROM (SELECT transaction_id FROM {relation} GROUP BY transaction_id HAVING count(*) > 1)",
            "FAIL",
            "Each transaction_id should be unique in the curated transaction table.",
        ),
        check(
            "negative_transaction_amount",
            f"SELECT count(*) AS n FROM {relation} WHERE amount <= 0",
            "FAIL",
            "Transaction amounts must remain positive.",
        ),
        check(
            "risk_score_above_100",
            f"SELECT count(*) AS n FROM {relation} WHERE risk_score > 100",
            "WARN",
            "Risk score should stay within the expected rule-based range.",
        ),
    ]
    if extras:
        rows.append(
            check(
                "missing_country_or_merchant",
                rf"SELECT count(*) AS n FROM {relation} WHERE regexp_full_match(coalesce(txn_country, ''), '\s*') "
                r"OR regexp_full_match(coalesce(merchant_id, ''), '\s*')",
                "FAIL",
                "Country and merchant attributes must be present.",
            )
        )
    return " UNION ALL ".join(rows)


_DEAD_LETTERS = f"""
SELECT transaction_id, errors, CAST(len(string_split(errors, '; ')) AS INTEGER) AS error_count,
       {_stamp('publish_ts', 'received_ts')}
FROM (SELECT *, {_errors(raw=False)} AS errors FROM sent) WHERE errors <> ''
"""

ORACLES = {
    "risk_scoring": f"""{TYPED}
SELECT transaction_id, {_stamp('transaction_ts')}, {_SCORE}, risk_level, risk_reasons FROM payments""",
    "normalized_events": f"{MESSAGES} SELECT {_BRONZE_COLUMNS} FROM payments",
    "dead_letter": f"{_with(_TYPED)} {_DEAD_LETTERS}",
    "dead_letter_replay": f"{_with(_TYPED)} {_DEAD_LETTERS}",
    "raw_validation": f"""{_with(_TYPED)}
SELECT transaction_id, {_stamp('publish_ts')}, {_errors(raw=True)} AS errors FROM sent""",
    "windowed_dedup": f"{TYPED_MINUTE} SELECT {_BRONZE_COLUMNS}, {_stamp('minute', 'window_start')} FROM bronze",
    "flagged_transactions": f"{TYPED_MINUTE} {_ALERTS}",
    "realtime_metrics": f"{TYPED_MINUTE} {_metrics()}",
    "suspicious_share": f"{TYPED_MINUTE} {_metrics(_SHARE)}",
    "silver_curated": f"{TYPED_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
    "merchant_hourly_kpis": f"{TYPED_SILVER} {_MERCHANTS}",
    "country_fraud_hotspots": f"{TYPED_SILVER} {_HOTSPOTS}",
    "dq_audit": f"{TYPED_SILVER} {_audit('silver')}",
    "dq_audit_bronze": f"{TYPED_SILVER} {_audit('payments')}",
    "dq_missing_attrs": f"{TYPED_SILVER} {_audit('silver', extras=True)}",
    "messages_to_hotspots": f"{MESSAGES_SILVER} {_HOTSPOTS}",
    "period_bronze": f"{MESSAGES_MINUTE} SELECT {_BRONZE_COLUMNS} FROM bronze",
    "period_alerts": f"{MESSAGES_MINUTE} {_ALERTS}",
    "period_rerun": f"{MESSAGES_MINUTE} SELECT {_BRONZE_COLUMNS} FROM bronze",
    "warehouse_silver": f"{TYPED_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
    "warehouse_hotspots": f"{TYPED_SILVER} {_HOTSPOTS}",
    "warehouse_merchants": f"{TYPED_SILVER} {_MERCHANTS}",
    "warehouse_audit": f"{TYPED_SILVER} {_audit('silver')}",
    "incremental_silver": f"{TYPED_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
    "incremental_merchants": f"{TYPED_SILVER} {_MERCHANTS}",
    "incremental_hotspots": f"{TYPED_SILVER} {_HOTSPOTS}",
    "streamed_bronze": f"{MESSAGES_PUBLISHED} SELECT {_BRONZE_COLUMNS} FROM published",
    "streamed_alerts": f"{MESSAGES_PUBLISHED} {_ALERTS.replace('FROM bronze', 'FROM published')}",
    "streamed_metrics": f"{MESSAGES_PUBLISHED} {_metrics().replace('FROM bronze', 'FROM published')}",
    "stream_update_metrics": f"{MESSAGES_MINUTE} {_metrics()}",
    "stream_bronze": f"{MESSAGES_MINUTE} SELECT {_BRONZE_COLUMNS} FROM bronze",
    "stream_alerts": f"{MESSAGES_MINUTE} {_ALERTS}",
    "stream_metrics": f"{MESSAGES_MINUTE} {_metrics()}",
    "stream_chained_metrics": f"{MESSAGES_MINUTE} {_metrics()}",
    "stream_dead_letters": f"{_with(_TYPED)} {_DEAD_LETTERS}",
    "period_dead_letters": f"{_with(_TYPED)} {_DEAD_LETTERS}",
    "replayed_bronze": f"""{_with(_TYPED, _MENDED, _SCORED.format(source="accepted"), _MINUTE)}
SELECT {_BRONZE_COLUMNS} FROM bronze""",
    "warehouse_by_name": f"{TYPED_SILVER} {_HOTSPOTS}",
    "observed_audit": f"{TYPED_SILVER} {_audit('payments')}",
    "dq_missing_attrs_failing": f"""{TYPED_SILVER}, spoiled AS (
  SELECT * REPLACE (CASE WHEN e % 9 = 0 THEN chr(9) || ' ' ELSE merchant_id END AS merchant_id,
                    CASE WHEN e % 13 = 0 THEN '' WHEN e % 17 <> 0 THEN txn_country END AS txn_country) FROM silver)
{_audit('spoiled', extras=True)}""",
}
