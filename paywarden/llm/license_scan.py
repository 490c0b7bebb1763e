"""License scans: phrase places, and an exact set-similarity join of text windows with license templates.

The blocks of a text are its word windows, regardless of line ends, so wrapped
notices are whole in a block. A window of a template starts at any of its words
and is ``SLACK`` longer than it. It meets the template if it contains at least
``CONTAINMENT`` of the template's different words, among them those that name
the license (the words of its label, if the template has them), and none that
names a variant of it which the template is not (``VARIANTS``).

The template words are ordered by how often they stand in the whole corpus,
rarest first. A window that lacks too many words of a template to meet it

* has none of its rarest words, one more of them than it may lack (prefix filter),
* or has too few places of template words (length filter),
* or has too few places of words that come after its rarest in the order, or
  too few of such words are left in the template (positional filter).

What passes all three is verified. The filters drop no window that meets.

Nulls: a null text has no words and no labels. Repeated rows are scanned
alike. A null id is kept. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.text_arrays import FOLDED, NOT_ALNUM, slices, words_in

CONTAINMENT = 0.8
SLACK = 0.25  # a window's words beyond the template's, as a share of them

# Words that tell variants of a license apart.
VARIANTS = ("affero", "lesser", "nc", "nd", "noncommercial", "noderivatives", "noderivs", "sa", "sharealike")

# Label and phrase, then label and template of a license notice.
PHRASES = (
    ("apache", "apache license"),
    ("gpl", "general public license"),
    ("mit", "mit license"),
)
TEMPLATES = (
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "this work is licensed under the gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc-nd", "this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "this work is licensed under the gnu lesser general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
)


def needed(words: int, containment: float) -> int:
    """Words of a template of ``words`` different words that a block must hold."""
    return max(1, math.ceil(round(containment * words, 9)))


def window_words(text: str) -> int:
    return math.ceil(len(text.split()) * (1 + SLACK))


def naming_words(label: str, words: list[str]) -> list[str]:
    """The words of a template that a window must have: those of its label and of its variant."""
    return sorted(set(words) & {*label.split("-"), *VARIANTS})


class Templates:
    """Template words as numbers in the order of their frequency, rarest first, with their hashes."""

    def __init__(self, templates: tuple[tuple[str, str], ...], containment: float, counts: dict[str, int]) -> None:
        self.labels = [label for label, _ in templates]
        sets = [set(text.split()) for _, text in templates]
        self.words = sorted(known_words(templates), key=lambda word: (counts.get(word, 0), word))
        self.sizes = [len(words) for words in sets]
        self.needed = [needed(size, containment) for size in self.sizes]
        self.windows = [window_words(text) for _, text in templates]
        # Per template, which of all words it has, their place in its own order, and which must and must not be there.
        self.held = np.array([[word in words for word in self.words] for words in sets])
        self.ranks = np.cumsum(self.held, axis=1) - 1
        self.naming = np.array([[w in naming_words(label, list(words)) for w in self.words] for label, words in zip(self.labels, sets)])
        self.foreign = np.array([[w in VARIANTS and w not in words for w in self.words] for words in sets])
        hashes = hashes_of(self.words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The known word of each hash, -1 for other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def spread(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Places with a gap between texts that no window spans."""
        return at + owner * max(self.windows)

    def windows_of(self, k: int, at: np.ndarray) -> np.ndarray:
        """Per place of a word of template ``k``, the end of the places in the window that starts there."""
        return np.searchsorted(at, at + self.windows[k])

    def by_prefix(self, k: int, ranks: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The windows that have one of the rarest words, of which a meeting window lacks one less at most."""
        rare = np.concatenate([[0], np.cumsum(ranks <= self.sizes[k] - self.needed[k])])
        return start[rare[end[start]] > rare[start]]

    def by_length(self, k: int, end: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The windows with as many places of template words as words are needed."""
        return start[end[start] - start >= self.needed[k]]

    def by_position(self, k: int, ranks: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The windows whose rarest word leaves enough words after it, in the template and in the window."""
        first = np.full(len(start), self.sizes[k])
        times = np.zeros(len(start), np.int64)
        for here in self.places(k, end, start):
            rank = np.where(here >= 0, ranks[here], self.sizes[k])
            times = np.where(rank < first, 1, times + (rank == first) * (here >= 0))
            first = np.minimum(first, rank)
        after = end[start] - start - times
        return start[1 + np.minimum(self.sizes[k] - 1 - first, after) >= self.needed[k]]

    def places(self, k: int, end: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """The first, second, ... place in each window, -1 beyond its end."""
        most = int((end[start] - start).max(initial=0))
        for step in range(most):
            yield np.where(start + step < end[start], start + step, -1)

    def contained(self, k: int, at: np.ndarray, numbers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that meet template ``k``: their texts, and the share of the template in each.

        ``at``, ``numbers`` and ``owner`` are the spread places, numbers and texts of all known words.
        """
        other = at[self.foreign[k][numbers]]
        mine = np.flatnonzero(self.held[k][numbers])
        at, numbers, owner = at[mine], numbers[mine], owner[mine]
        ranks, end = self.ranks[k][numbers], self.windows_of(k, at)
        start = self.by_prefix(k, ranks, end, np.arange(len(at)))
        start = self.by_length(k, end, start)
        start = self.by_position(k, ranks, end, start)
        return self.verified(k, at, numbers, owner, other, end, start)

    def verified(
        self, k: int, at: np.ndarray, numbers: np.ndarray, owner: np.ndarray, other: np.ndarray, end: np.ndarray, start: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The windows among those at ``start`` that meet the template."""
        n = len(at)
        order = np.lexsort((np.arange(n), numbers))
        again = numbers[order[1:]] == numbers[order[:-1]]
        before = np.full(n, -1)  # the place before of the same word
        before[order[1:][again]] = order[:-1][again]
        names = self.naming[k][numbers]
        shared, named = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for here in self.places(k, end, start):
            new = (here >= 0) & (before[here] < start)
            shared += new
            named += new & names[here]
        free = np.searchsorted(other, at[start]) == np.searchsorted(other, at[start] + self.windows[k])
        met = (shared >= self.needed[k]) & (named == self.naming[k].sum()) & free
        return owner[start[met]], shared[met] / self.sizes[k]


def known_words(templates: tuple[tuple[str, str], ...]) -> set[str]:
    return set(VARIANTS).union(*(text.split() for _, text in templates))


def hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return words_in(data, np.array([0, len(data)]), NOT_ALNUM, FOLDED).hashes


def phrase_starts(hashes: np.ndarray, owner: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """First words of the places where the phrase stands inside one text."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(hashes[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[(hashes[at + k] == phrase[k]) & (owner[at + k] == owner[at])]
    return at


def word_counts(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of ``words``, a fixed small list, stands in all texts; one number per word leaves a task."""
    hashes = hashes_of(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(hashes)
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column("text")):
                found = words_in(data, offsets, NOT_ALNUM, FOLDED).hashes
                at = np.minimum(np.searchsorted(hashes[order], found), len(words) - 1)
                total += np.bincount(order[at[hashes[order][at] == found]], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total)], ["word", "n"])

    counted = texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {words[row["word"]]: row["n"] for row in counted.collect()}


SCANNED = "n_words long, n_base long, first_word long, last_word long, base array<int>, met array<int>, share double"


def scanner(templates: Templates, phrases: tuple[tuple[str, str], ...]):
    """A function for ``mapInArrow``: ``doc_id``, base results, the templates met and the largest share."""
    sought = [hashes_of(text.split()) for _, text in phrases]
    size = len(templates.labels)

    def nested(counts: np.ndarray, values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in slices(batch.column("text")):
                n = end - first
                words = words_in(data, offsets, NOT_ALNUM, FOLDED)
                owner = words.owner
                places = [phrase_starts(words.hashes, owner, phrase) for phrase in sought]
                at = np.concatenate(places)
                kind = np.repeat(np.arange(len(places)), [len(p) for p in places])
                total = np.bincount(owner[at], minlength=n)
                lowest, highest = np.full(n, 1 << 62), np.full(n, -1)
                np.minimum.at(lowest, owner[at], at - words.first[owner[at]])
                np.maximum.at(highest, owner[at], at - words.first[owner[at]])
                found = np.unique(owner[at] * len(sought) + kind)
                numbers = templates.numbers(words.hashes)
                known = np.flatnonzero(numbers >= 0)
                at_known = templates.spread(known, owner[known])
                share = np.zeros(n)
                cells = [np.empty(0, np.int64)]
                for k in range(size):
                    texts, shares = templates.contained(k, at_known, numbers[known], owner[known])
                    np.maximum.at(share, texts, shares)
                    cells.append(texts * size + k)
                met = np.unique(np.concatenate(cells))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(total.astype(np.int64)),
                        pa.array(lowest, mask=total == 0),
                        pa.array(highest, mask=total == 0),
                        nested(np.bincount(found // len(sought), minlength=n), pa.array((found % len(sought)).astype(np.int32))),
                        nested(np.bincount(met // size, minlength=n), pa.array((met % size).astype(np.int32))),
                        pa.array(share),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base", "met", "share"],
                )

    return scan


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Labels of each row of ``docs``: of phrases, of templates, and the best containment.

    The windows of a text stay in its task, so the join needs no shuffle: the
    templates, a fixed small table, go to all tasks in the order that a first
    pass over all texts gives their words.
    """
    given = docs.select("doc_id", "text")
    known = Templates(templates, containment, word_counts(given, sorted(known_words(templates))))
    id_type = given.schema["doc_id"].dataType.simpleString()
    scanned = given.mapInArrow(scanner(known, phrases), f"doc_id {id_type}, {SCANNED}")

    def labels_of(column: str, labels: list[str]) -> Column:
        names = F.array(*map(F.lit, labels)).cast("array<string>")
        return F.array_sort(F.array_distinct(F.transform(column, lambda i: F.element_at(names, i + 1))))

    base = labels_of("base", [label for label, _ in phrases])
    met = labels_of("met", known.labels)
    return scanned.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, met)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.col("share")).alias("score"),
    )
