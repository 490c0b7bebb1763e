"""Raw message text to one column per required key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.functions.coerce import truthy
from paywarden.schemas import REQUIRED_FIELDS

FLAG_FIELDS = ("is_card_present", "is_new_device", "simulated_fraud_label")
TEXT_FIELDS = tuple(name for name in REQUIRED_FIELDS if name not in FLAG_FIELDS)

# Fixed value: the message for a payload that is JSON but no object.
NOT_AN_OBJECT = "The Pub/Sub message must be a JSON object."
MALFORMED = "malformed JSON"
NOT_UTF8 = "payload is not valid UTF-8"

_PAYLOAD = "array<struct<{}>>".format(
    ",".join(f"{name}:{'boolean' if name in FLAG_FIELDS else 'string'}" for name in REQUIRED_FIELDS)
)
_STRICT = {"allowSingleQuotes": "false"}


def decode_payload(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Bytes to ``raw_message``; bytes that are no UTF-8 are kept as base64 with ``decode_error`` set."""
    text = F.col(payload).cast("string")
    valid = F.is_valid_utf8(text)
    rest = [name for name in messages.columns if name != payload]
    return messages.select(
        *rest,
        F.when(valid, text).otherwise(F.base64(payload)).alias("raw_message"),
        F.when(~valid, F.lit(NOT_UTF8)).alias("decode_error"),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add one column per required key and ``parse_error`` to rows with ``raw_message``.

    NULL stands for a missing key. Texts, among them the amount, have a JSON
    null as ``'None'``; flags are the truth of their JSON value.
    ``parse_error`` is NULL for a JSON object.

    Most messages need one pass over the text with a fixed schema. A row where
    that leaves a doubt, for example between a missing key and a null, is read
    a second time as a variant. Putting the text in brackets makes anything
    after the object an error, and reading the single element with a generator
    keeps later filters from being pushed below the parse and running it twice.
    """
    carried = [name for name in messages.columns if name != "decode_error"]
    decode_error = (
        F.col("decode_error") if "decode_error" in messages.columns else F.lit(None).cast("string")
    )
    bracketed = F.concat(F.lit("["), F.col("raw_message"), F.lit("]"))
    documents = messages.select(
        *carried,
        decode_error.alias("_decode_error"),
        F.from_json(bracketed, _PAYLOAD, _STRICT).alias("_documents"),
    )

    first = F.get("_documents", F.lit(0))
    unclear = F.col("_documents").isNull() | (F.size("_documents") != 1)
    for name in REQUIRED_FIELDS:
        unclear = unclear | first.getField(name).isNull()
    for name in TEXT_FIELDS:
        unclear = unclear | first.getField(name).isin("true", "false")
    read_again = documents.select(
        *carried,
        "_decode_error",
        "_documents",
        F.when(unclear, F.try_parse_json(bracketed)).alias("_bracketed"),
        unclear.alias("_unclear"),
    )

    # A closing bracket right after an object may end the added bracket early. Few texts have
    # one at all, which is told without the search by pattern.
    closes_early = F.col("raw_message").contains("]") & F.col("raw_message").rlike(r"\}\s*\]") & F.expr(
        "try_parse_json(concat('{\"m\":', raw_message, '}')) IS NULL"
    )
    element = F.try_variant_get("_bracketed", "$[0]", "variant")
    second_error = F.when(
        element.isNull() | F.try_variant_get("_bracketed", "$[1]", "variant").isNotNull(),
        F.lit(MALFORMED),
    ).when(~F.schema_of_variant(element).startswith("OBJECT"), F.lit(NOT_AN_OBJECT))
    parse_error = F.coalesce(
        F.col("_decode_error"),
        F.when(closes_early, F.lit(MALFORMED)),
        F.when(F.col("_unclear"), second_error),
    )
    checked = read_again.select(*carried, "_documents", "_bracketed", parse_error.alias("parse_error"))
    final = F.when(F.col("_bracketed").isNull(), F.col("_documents")).otherwise(
        F.array(_read_variant(element, first))
    )
    return checked.select(
        *carried, "parse_error", F.when(F.col("parse_error").isNull(), final).alias("_documents")
    ).select(*carried, "parse_error", F.inline_outer("_documents"))


def _read_variant(document: Column, first: Column) -> Column:
    """The required keys of a JSON object with the distinctions of a dynamic producer.

    A text that the ``first`` reading left no doubt of is kept, so that it does
    not depend on what other fields hold.
    """
    fields = []
    for name in REQUIRED_FIELDS:
        value = F.try_variant_get(document, f"$.{name}", "variant")
        text = value.cast("string")
        is_boolean = F.schema_of_variant(value) == "BOOLEAN"
        if name in FLAG_FIELDS:
            field = F.when(value.isNotNull(), truthy(value))
        elif name == "amount":
            # A boolean counts as one or zero.
            field = F.when(is_boolean, F.when(text == "true", "1").otherwise("0")).otherwise(text)
        else:
            field = F.when(is_boolean, F.initcap(text)).otherwise(text)
        if name in TEXT_FIELDS:
            field = F.when(F.is_variant_null(value), F.lit("None")).otherwise(field)
            known = first.getField(name)
            field = F.when(known.isNotNull() & ~known.isin("true", "false"), known).otherwise(field)
        fields.append(field.alias(name))
    return F.struct(*fields)
