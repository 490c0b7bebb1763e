"""From message text to bronze rows and error lists."""

import json

from pyspark.sql import functions as F

from paywarden.operators.alerts import high_risk_alerts
from paywarden.operators.metrics import minute_metrics
from paywarden.operators.parse import decode_payload, parse_messages
from paywarden.operators.validate import (
    dead_letters,
    process_messages,
    valid_payments,
    validate_raw,
)
from paywarden.schemas import ALERTS, BRONZE, METRICS
from tests.conftest import event, messages

AS_OF = "publish_ts"


def processed(spark, payloads, publish="2024-05-01T10:02:00"):
    return process_messages(messages(spark, payloads, publish), AS_OF).orderBy("n").collect()


def one(spark, payload, publish="2024-05-01T10:02:00"):
    return processed(spark, [payload], publish)[0]


# The five base cases.


def test_parse_keeps_the_id(spark):
    row = parse_messages(messages(spark, [event()])).first()
    assert row.transaction_id == "P-7f3a" and row.parse_error is None


def test_high_risk_is_scored(spark):
    row = one(spark, event())
    assert (row.risk_level, row.risk_score) == ("HIGH", 100)
    assert row.risk_reasons == [
        "HIGH_AMOUNT",
        "CROSS_BORDER",
        "CARD_NOT_PRESENT",
        "NEW_DEVICE",
        "RISKY_MERCHANT_CATEGORY",
    ]


def test_raw_validation_rejects_negative_amount(spark):
    row = validate_raw(parse_messages(messages(spark, [event(amount=-1)])), AS_OF).first()
    assert row.errors == ["amount must be greater than zero"]


def test_alert_keeps_core_fields(spark):
    payments = valid_payments(process_messages(messages(spark, [event(), event(amount=5, is_new_device=False)]), AS_OF))
    alerts = high_risk_alerts(payments, F.lit("2024-05-01 11:00:00.7").cast("timestamp"))
    assert alerts.columns == ALERTS.fieldNames()
    rows = alerts.collect()
    assert [(r.transaction_id, r.risk_level) for r in rows] == [("P-7f3a", "HIGH")]
    assert rows[0].alert_created_ts.microsecond == 0


def test_metrics_count_risk(spark):
    payments = valid_payments(process_messages(messages(spark, [event()]), AS_OF))
    metrics = minute_metrics(payments, F.col("publish_ts"), F.current_timestamp())
    assert metrics.columns == METRICS.fieldNames()
    row = metrics.first()
    assert (row.total_transactions, row.high_risk_transactions, row.simulated_fraud_transactions) == (1, 1, 1)
    assert (row.window_end - row.window_start).total_seconds() == 60


# Parsing.


DOCUMENTS = [
    ('{"a": 1', "malformed JSON"),
    ("", "malformed JSON"),
    (None, "malformed JSON"),
    ("{'a': 1}", "malformed JSON"),
    ('{"a": 1} x', "malformed JSON"),
    ('{"a": 1},{"a": 2}', "malformed JSON"),
    ('{"a": 1}] [2', "malformed JSON"),
    ('{"a": 1} ]', "malformed JSON"),
    ('{"city": "a\tb"}', "malformed JSON"),
    ("[]", "The Pub/Sub message must be a JSON object."),
    ('[{"a": 1}]', "The Pub/Sub message must be a JSON object."),
    ("null", "The Pub/Sub message must be a JSON object."),
    ("7", "The Pub/Sub message must be a JSON object."),
    ('"text"', "The Pub/Sub message must be a JSON object."),
    ("{}", "'transaction_ts'"),
    ('{"a": [{}], "b": 1}', "'transaction_ts'"),
]


def test_documents(spark):
    rows = processed(spark, [text for text, _ in DOCUMENTS])
    assert [r.errors for r in rows] == [[error] for _, error in DOCUMENTS]


def test_brackets_inside_an_object_are_fine(spark):
    assert one(spark, event(extra=[{"a": 1}, {"b": [{}]}])).errors == []


def test_a_repeated_key_takes_its_last_value(spark):
    text = '{"city": "first", ' + __import__("json").dumps(event(city="last"))[1:]
    assert one(spark, text).city == "last"
    with_null = text.replace('"device_id": "D-9"', '"device_id": null')
    assert (one(spark, with_null).city, one(spark, with_null).device_id) == ("last", "None")


def test_bytes_that_are_no_utf8_are_dead_lettered(spark):
    raw = spark.createDataFrame([(bytearray(b"\xff\xfe{"),), (bytearray(b"{}"),)], "value binary")
    decoded = decode_payload(raw.withColumn("publish_ts", F.current_timestamp()))
    rows = {r.raw_message: r.errors for r in process_messages(decoded, AS_OF).collect()}
    assert rows == {"//57": ["payload is not valid UTF-8"], "{}": ["'transaction_ts'"]}


# Coercion.


MISSING = [
    (("transaction_ts", "amount"), "'transaction_ts'"),
    (("amount", "txn_country"), "'amount'"),
    (("txn_country", "is_new_device"), "'txn_country'"),
    (("is_card_present", "transaction_id"), "'is_card_present'"),
    (("transaction_id", "ingest_source"), "'transaction_id'"),
    (("simulated_fraud_label", "ingest_source"), "'simulated_fraud_label'"),
    (("ingest_source",), "'ingest_source'"),
]


def test_the_first_missing_key_is_reported(spark):
    rows = processed(spark, [event(without) for without, _ in MISSING])
    assert [r.errors for r in rows] == [[first] for _, first in MISSING]


def test_a_bad_timestamp_comes_before_a_bad_amount(spark):
    rows = processed(
        spark, [event(transaction_ts="soon", amount="x"), event(("transaction_id",), amount="x")]
    )
    assert [r.errors for r in rows] == [["Invalid transaction_ts"], ["amount must be numeric"]]


def test_null_becomes_text(spark):
    names = ("customer_id", "currency", "txn_status", "amount", "transaction_ts")
    rows = processed(spark, [event(**{name: None}) for name in names])
    assert rows[0].customer_id == "None"
    assert [r.errors for r in rows] == [
        [],
        ["currency must be a 3-letter code"],
        ["Unsupported txn_status: NONE"],
        ["amount must be numeric"],
        ["Invalid transaction_ts"],
    ]


def test_other_json_types_become_text(spark):
    row = one(spark, event(customer_id=12, card_id=True, device_id="true", city=False))
    assert (row.customer_id, row.card_id, row.device_id, row.city) == ("12", "True", "true", "False")


TRUTHS = [
    (True, True),
    (False, False),
    ("false", True),
    ("", False),
    (0, False),
    (0.0, False),
    (-0.0, False),
    (2, True),
    (0.5, True),
    (None, False),
    ([], False),
    ([0], True),
    ({}, False),
    ({"a": 1}, True),
]


def test_flags_follow_truth(spark):
    events = [
        event(is_card_present=v, is_new_device=v, simulated_fraud_label=v) for v, _ in TRUTHS
    ]
    for row, (value, truth) in zip(processed(spark, events), TRUTHS):
        flags = (row.is_card_present, row.is_new_device, row.simulated_fraud_label)
        assert flags == (truth, truth, truth), value
        assert ("CARD_NOT_PRESENT" in row.risk_reasons) is not truth
        assert ("NEW_DEVICE" in row.risk_reasons) is truth


AMOUNTS = [
    (12.5, 12.5),
    ("12.5", 12.5),
    (" 12.5 ", 12.5),
    ("1_000", 1000.0),
    ("1e2", 100.0),
    ("+.5", 0.5),
    ("7.", 7.0),
    (True, 1.0),
    (0.625, 0.62),
    (0.375, 0.38),
    (2.675, 2.67),
    (1.005, 1.0),
    (1e300, 1e300),
]


def test_amounts(spark):
    rows = processed(spark, [event(amount=value) for value, _ in AMOUNTS])
    assert [(r.errors, r.amount) for r in rows] == [([], amount) for _, amount in AMOUNTS]


NO_AMOUNTS = ["abc", "12d", "1__0", "_1", "", "nan", "inf", "1e999", "true", [1], {}, "0x10"]


def test_amounts_that_are_no_numbers(spark):
    rows = processed(spark, [event(amount=value) for value in NO_AMOUNTS])
    assert [r.errors for r in rows] == [["amount must be numeric"]] * len(NO_AMOUNTS)


def test_an_amount_is_rounded_before_its_check(spark):
    rows = processed(spark, [event(amount=value) for value in (0.004, False, 0.006)])
    assert [r.errors for r in rows] == [["amount must be greater than zero"]] * 2 + [[]]
    assert rows[2].amount == 0.01


TIMESTAMPS = [
    ("2024-05-01T10:00:00Z", "2024-05-01 10:00:00"),
    ("2024-05-01T10:00:00", "2024-05-01 10:00:00"),
    ("2024-05-01 10:00", "2024-05-01 10:00:00"),
    ("2024-05-01T10", "2024-05-01 10:00:00"),
    ("2024-05-01", "2024-05-01 00:00:00"),
    ("2024-05-01T10:00:00.999999+02:00", "2024-05-01 08:00:00"),
    ("2024-05-01T00:30:00+01:00", "2024-04-30 23:30:00"),
]


def test_timestamps(spark):
    raw = messages(spark, [event(transaction_ts=text) for text, _ in TIMESTAMPS])
    rows = process_messages(raw, AS_OF).select(
        "n",
        F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("transaction_date").cast("string").alias("day"),
        "errors",
    )
    found = [(r.ts, r.day, r.errors) for r in rows.orderBy("n").collect()]
    assert found == [(stored, stored[:10], []) for _, stored in TIMESTAMPS]


NO_TIMESTAMPS = ["2024", "10:00", "2024-02-30", "2024-05-01T25:00:00", "", " 2024-05-01", "2024-05-01\n", 20240501]


def test_texts_that_are_no_timestamps(spark):
    rows = processed(spark, [event(transaction_ts=text) for text in NO_TIMESTAMPS])
    assert [r.errors for r in rows] == [["Invalid transaction_ts"]] * len(NO_TIMESTAMPS)


def test_case_and_projection(spark):
    rows = process_messages(messages(spark, [event(merchant_category="TraVel", extra=1)]), AS_OF)
    assert valid_payments(rows).columns == ["publish_ts", *BRONZE.fieldNames()]
    row = rows.first()
    assert (row.merchant_category, row.currency, row.home_country) == ("travel", "NOK", "NO")
    assert (row.txn_country, row.payment_method, row.txn_status) == ("PT", "AMEX", "APPROVED")


def test_lateness_is_strict_and_uses_full_precision(spark):
    late = [
        r.is_late_arrival
        for r in processed(
            spark,
            [event()] * 3 + [event(transaction_ts="2024-05-01T10:00:00.5Z")],
            ["2024-05-01T10:05:00", "2024-05-01T10:05:01", "2024-05-01T10:05:00.000001", "2024-05-01T10:05:00.5"],
        )
    ]
    assert late == [False, True, True, False]


def test_future_is_checked_on_whole_seconds(spark):
    now = "2024-05-01T10:00:00.2"
    assert one(spark, event(transaction_ts="2024-05-01T10:00:00.9Z"), now).errors == []
    assert one(spark, event(transaction_ts="2024-05-01T10:00:01Z"), now).errors == [
        "transaction_ts cannot be in the future"
    ]


# Scoring.


SCORES = [
    ({"amount": 799.99}, 0, "LOW"),
    ({"amount": 800}, 20, "LOW"),
    ({"amount": 1499.99}, 20, "LOW"),
    ({"amount": 1499.999}, 20, "LOW"),
    ({"amount": 1500}, 40, "MEDIUM"),
    ({"txn_country": "gb"}, 25, "LOW"),
    ({"txn_country": "NO"}, 25, "LOW"),
    ({"txn_country": "gb", "txn_status": "declined"}, 30, "MEDIUM"),
    ({"amount": 1500, "is_new_device": True}, 55, "MEDIUM"),
    ({"amount": 1500, "is_new_device": True, "txn_status": "Declined"}, 60, "HIGH"),
    ({"amount": 1500, "txn_country": "gb", "is_card_present": False}, 75, "HIGH"),
    ({"amount": 1500, "txn_country": "gb", "is_new_device": True}, 80, "HIGH"),
    ({"merchant_category": "GIFT_cards"}, 10, "LOW"),
]


def test_scores(spark):
    plain = dict(
        amount=10, txn_country="no", is_card_present=True, is_new_device=False, merchant_category="fuel"
    )
    rows = processed(spark, [event(**{**plain, **changes}) for changes, _, _ in SCORES])
    assert [(r.risk_score, r.risk_level) for r in rows] == [(s, level) for _, s, level in SCORES]


def test_the_highest_score(spark):
    row = one(spark, event(txn_status="declined"))
    assert row.risk_score == 105 and row.risk_reasons[-1] == "DECLINED_TRANSACTION"


# Validation and dead letters.


def test_all_value_errors_are_collected_in_order(spark):
    bad = event(
        amount=-5,
        currency="us",
        txn_status="held",
        transaction_ts="2999-01-01T00:00:00Z",
        merchant_id=" \t",
        txn_country=" ",
    )
    assert one(spark, bad).errors == [
        "amount must be greater than zero",
        "currency must be a 3-letter code",
        "Unsupported txn_status: HELD",
        "transaction_ts cannot be in the future",
        "merchant_id cannot be empty",
        "txn_country cannot be empty",
    ]
    row = validate_raw(parse_messages(messages(spark, [bad])), AS_OF).first()
    assert row.errors[2] == "Unsupported txn_status: held" and len(row.errors) == 6


def test_raw_validation(spark):
    cases = [
        event(("txn_status", "amount", "device_id")),
        event(amount="x", transaction_ts="x"),
        event(amount=0.004),
        event(),
        "[]",
    ]
    rows = validate_raw(parse_messages(messages(spark, cases)), AS_OF).orderBy("n").collect()
    assert [r.errors for r in rows] == [
        ["Missing required fields: amount, device_id, txn_status"],
        ["Invalid transaction_ts", "amount must be numeric"],
        [],
        [],
        ["The Pub/Sub message must be a JSON object."],
    ]


def test_dead_letter_records(spark):
    rows = process_messages(messages(spark, [event(), event(currency="x", amount=-1), "nope"]), AS_OF)
    letters = {r.raw_message: r for r in dead_letters(rows, AS_OF).collect()}
    assert len(letters) == 2
    assert letters["nope"].errors == ["malformed JSON"]
    assert sorted(r.error_count for r in letters.values()) == [1, 2]
    assert valid_payments(rows).count() == 1


def test_a_text_does_not_depend_on_other_fields(spark):
    given = {
        "1.0": "1.0",
        "-0.0": "-0.0",
        "1": "1",
        "1.50": "1.5",
        "9" * 42: "9" * 42,
        '{"b": 1, "a": [1.0, null]}': '{"b":1,"a":[1.0,null]}',
        "true": "True",
        "null": "None",
    }
    others = [{}, {"city": None}, {"city": "true"}, {"is_card_present": "false"}, {"is_new_device": [1]}]
    texts = [
        json.dumps(event(customer_id="@", **other)).replace('"@"', value) for value in given for other in others
    ]
    texts += [json.dumps(event(without=["city"], customer_id="@")).replace('"@"', value) for value in given]
    rows = parse_messages(messages(spark, texts)).orderBy("n").collect()
    wanted = [text for text in given.values() for _ in others] + list(given.values())
    assert [r.customer_id for r in rows] == wanted
