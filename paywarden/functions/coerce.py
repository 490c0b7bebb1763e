"""JSON values to column types, with the loose typing a dynamic producer allows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal number as a dynamic producer may write it: blanks around it, digit
# groups joined by underscores. Infinity and NaN are left out on purpose.
_DIGITS = r"[0-9]+(_[0-9]+)*"
_NUMBER = rf"^\s*[+-]?({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\s*\z"

# Calendar date, then optionally a time of day and an offset.
_INSTANT = (
    r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?\z"
)

_BLANK = r"(?U)^[\s\x1c-\x1f]*\z"


def truthy(value: Column) -> Column:
    """Truth of a variant: empty text, zero, null and empty containers are false, so ``"false"`` is true."""
    kind = F.schema_of_variant(value)
    text = value.cast("string")
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind == "STRING", text != "")
        .when(kind == "VOID", F.lit(False))
        .when(kind.startswith("ARRAY"), text != "[]")
        .when(kind.startswith("OBJECT"), text != "{}")
        .otherwise(text.try_cast("double") != 0)
    )


def number(text: Column) -> Column:
    """Double of a numeric text, else NULL. A text beyond the range of doubles gives infinity."""
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def is_number(value: Column) -> Column:
    """Neither NULL nor infinite."""
    return F.coalesce(F.abs(value) < float("inf"), F.lit(False))


def instant(text: Column) -> Column:
    """ISO-8601 text to an instant, without an offset read as UTC, else NULL."""
    return F.when(text.rlike(_INSTANT), text.try_cast("timestamp"))


def is_blank(text: Column) -> Column:
    """Empty, or nothing but whitespace."""
    return text.rlike(_BLANK)
