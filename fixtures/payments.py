"""Card payments derived from the given ``events``, ``customer`` and ``nation`` tables.

``typed_payments`` gives the rows as typed columns, ``raw_messages`` the same
rows as JSON text with faults put in. Everything is a function of the row, so
the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATEGORIES = ("grocery", "electronics", "travel", "gaming", "luxury", "fuel", "gift_cards")
METHODS = ("visa", "mastercard", "amex")

# 2024-01-01T00:00:00Z
START = 1_704_067_200

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def typed_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed payments with ``event_id``, ``copy`` and ``publish_ts``; copies share an id.

    The joins carry no hints: Spark broadcasts a side only below its size
    threshold and otherwise shuffles, splitting a customer with many events.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")

    e = F.col("event_id")
    home_key = (F.col("c_nationkey") % 5).cast("int")
    txn_key = ((F.col("c_nationkey") + F.when(e % 6 == 0, 1 + e % 4).otherwise(0)) % 5).cast("int")
    keyed = (
        events.join(customer, F.col("user_id") == F.col("c_custkey"))
        .withColumns({"home_key": home_key, "txn_key": txn_key})
        .join(nation.toDF("home_key", "home_name"), "home_key")
        .join(nation.toDF("txn_key", "txn_name"), "txn_key")
    )
    copies = keyed.withColumn(
        "copy",
        F.explode(F.when(e % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )

    shift = F.when(F.col("copy") == 0, 0).when(e % 40 == 0, 3).otherwise(45)
    seconds = (
        START
        + (e % 3) * 86_400
        + F.when(e % 23 < 12, 0).otherwise(3_600)
        + (e * 37) % 600
        + shift
    )
    delay = F.when(e % 40 == 1, 400).when(e % 40 == 21, 300).when(e % 40 == 31, 301).otherwise(e % 10)
    extreme = e % 500 == 250
    same_country = e % 500 == 150

    def unless_extreme(value, usual: Column) -> Column:
        return F.when(extreme, F.lit(value)).otherwise(usual)

    return copies.select(
        "event_id",
        "copy",
        F.timestamp_seconds(seconds + delay).alias("publish_ts"),
        F.concat(F.lit("TXN-"), F.lpad(e.cast("string"), 12, "0")).alias("transaction_id"),
        F.concat(F.lit("CUST-"), F.col("user_id")).alias("customer_id"),
        F.concat(F.lit("CARD-"), F.col("user_id") * 3 + e % 3).alias("card_id"),
        F.concat(F.lit("MER-"), 1000 + (e * 7919) % 13).alias("merchant_id"),
        unless_extreme("luxury", _pick(CATEGORIES, (e * 31) % 7)).alias("merchant_category"),
        unless_extreme(2000.0, (F.col("value") * 10).cast("decimal(18,2)").cast("double")).alias("amount"),
        F.lit("usd").alias("currency"),
        F.when(same_country, F.lower("txn_name")).otherwise(F.col("home_name")).alias("home_country"),
        F.when(extreme, F.concat("home_name", F.lit("X"))).otherwise(F.col("txn_name")).alias("txn_country"),
        F.concat(F.lit("City-"), F.col("txn_key")).alias("city"),
        F.concat(F.lit("DEV-"), F.col("user_id") * 5 + e % 5).alias("device_id"),
        _pick(METHODS, e % 3).alias("payment_method"),
        F.timestamp_seconds(seconds).alias("transaction_ts"),
        F.when(extreme | (F.col("event_type") == "error"), "declined").otherwise("approved").alias("txn_status"),
        unless_extreme(False, (e * 7) % 11 >= 4).alias("is_card_present"),
        unless_extreme(True, e % 17 < 3).alias("is_new_device"),
        ((e % 11 == 0) | (F.col("value") >= 150)).alias("simulated_fraud_label"),
        F.lit("fixture").alias("ingest_source"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_message`` and ``publish_ts`` of every payment, with a fault in twelve of fifty event ids."""
    typed = typed_payments(spark, sf_dir)
    fault = F.col("event_id") % 50

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def text(name: str, faults: dict[int, str] | None = None) -> Column:
        value = F.col(name)
        for code, wrong in (faults or {}).items():
            value = F.when(fault == code, F.lit(wrong)).otherwise(value)
        return quoted(value)

    amount = F.col("amount").cast("decimal(18,2)").cast("string")
    tokens = {
        "transaction_id": text("transaction_id"),
        "customer_id": text("customer_id"),
        "card_id": text("card_id"),
        "merchant_id": text("merchant_id", {29: "  "}),
        "merchant_category": text("merchant_category"),
        "amount": F.when(fault == 7, F.concat(F.lit("-"), amount))
        .when(fault == 9, "0.004")
        .when(fault == 41, '"abc"')
        .otherwise(amount),
        "currency": text("currency", {11: "us", 37: "us"}),
        "home_country": text("home_country"),
        "txn_country": text("txn_country", {43: ""}),
        "city": text("city"),
        "device_id": F.when(fault != 17, text("device_id")),
        "payment_method": text("payment_method"),
        "transaction_ts": F.when(fault == 31, quoted(F.lit("2999-01-01T00:00:00Z"))).otherwise(
            quoted(F.date_format("transaction_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        ),
        "txn_status": text("txn_status", {23: "pending", 37: "pending"}),
        "is_card_present": F.when(fault == 47, '"false"').otherwise(F.col("is_card_present").cast("string")),
        "is_new_device": F.col("is_new_device").cast("string"),
        "simulated_fraud_label": F.col("simulated_fraud_label").cast("string"),
        "ingest_source": text("ingest_source"),
    }
    # A NULL token leaves its key out.
    pairs = [F.concat(F.lit(f'"{name}":'), token) for name, token in tokens.items()]
    document = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    message = (
        F.when(fault == 13, F.substring(document, F.lit(1), (F.length(document) / 2).cast("int")))
        .when(fault == 19, F.concat(F.lit("["), document, F.lit("]")))
        .otherwise(document)
    )
    return typed.select(message.alias("raw_message"), "publish_ts")


def heartbeat(spark: SparkSession) -> DataFrame:
    """One valid message published far in the future, which lets every earlier minute close."""
    return spark.sql(
        """
        SELECT '{"transaction_id":"TXN-HEARTBEAT","customer_id":"-","card_id":"-","merchant_id":"-",'
            || '"merchant_category":"none","amount":1,"currency":"usd","home_country":"-","txn_country":"-",'
            || '"city":"-","device_id":"-","payment_method":"visa","transaction_ts":"2024-01-01T00:00:00Z",'
            || '"txn_status":"approved","is_card_present":true,"is_new_device":false,'
            || '"simulated_fraud_label":false,"ingest_source":"fixture"}' AS raw_message,
            timestamp '2100-01-01 00:00:00' AS publish_ts
        """
    )
