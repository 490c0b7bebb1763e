"""Lists of texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(texts: Iterable[Column]) -> Column:
    """The different non-NULL texts as an array, in the given order.

    Leaving NULL out with a set difference stays inside generated code, which
    ``array_compact`` and other lambda functions do not.
    """
    texts = list(texts)
    nothing = F.array().cast("array<string>")
    only_null = F.array(F.lit(None).cast("string"))
    return F.when(F.coalesce(*texts).isNull(), nothing).otherwise(
        F.array_except(F.array(*texts), only_null)
    )
