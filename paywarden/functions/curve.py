"""A sort key that gives every one of several text columns narrow ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTER_BITS = 5
KEY_BITS = 60


def spread_letters(columns: int) -> list[int]:
    """Each letter code with its bits moved apart, ``columns - 1`` places between them."""
    return [
        sum((code >> bit & 1) << bit * columns for bit in range(LETTER_BITS))
        for code in range(1 << LETTER_BITS)
    ]


def interleaved(texts: Sequence[Column]) -> Column:
    """The bits of the first letters of all texts in turn, as one number.

    Rows in the order of this number are near each other in every text at once;
    a plain sort leaves the last text spread over all files. A letter has five
    bits, in the order of the alphabet and without case; blanks, digits and
    punctuation come first, NULL like an empty text. So texts that begin alike
    get the same number, and the caller sorts by the texts after it.
    """
    columns = len(texts)
    letters = KEY_BITS // (LETTER_BITS * columns)
    table = F.array(*map(F.lit, spread_letters(columns)))

    def bits(text: Column, letter: int, column: int) -> Column:
        code = F.ascii(F.substring(F.lower(text), letter + 1, 1)) - (ord("a") - 1)
        within = F.least(F.greatest(F.coalesce(code, F.lit(0)), F.lit(0)), F.lit((1 << LETTER_BITS) - 1))
        place = (letters - 1 - letter) * LETTER_BITS * columns + columns - 1 - column
        return F.shiftleft(F.element_at(table, within + 1).cast("bigint"), place)

    parts = [bits(text, letter, column) for letter in range(letters) for column, text in enumerate(texts)]
    return reduce(lambda whole, part: whole + part, parts)
