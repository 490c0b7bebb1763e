"""Benchmark decontamination by spaced-seed hashing.

A mask selects some of the positions of a run of words and ignores the others,
so two runs that differ only in ignored words have the same hash. The hashes of
all runs of the benchmark under each mask are looked up for all runs of the
training texts. Around a hit, text and item are laid over each other: a window
of ``MIN_OVERLAP`` words (the whole item if it is shorter) of which
``MIN_MATCHED`` match is an overlap; windows that overlap are one, and windows
apart on one alignment are overlaps of their own. The masks
hit every window of ``MIN_OVERLAP`` words with up to two substitutions, which
is as many as the share allows.

Words are runs of letters and digits, A-Z in lower case. Items of fewer than
``MIN_ITEM`` words are no evidence and are left out; items shorter than
``MIN_OVERLAP`` are found through masks of their own length, which between them
ignore every set of words that the share allows to differ.

The benchmark is taken in blocks of ``BLOCK_WORDS`` words, each sent to all
tasks; texts are never shuffled, however many share a passage. Of several
blocks one is held at a time, and what it leaves is written. Common seeds are
listed ``HIT_PAIRS`` at a time and only their alignments kept, so repetitive
texts and items take bounded memory.

Nulls: a null text has no words and stays; a null item text is left out, a null item id is kept.
Repeated rows and items are treated alike. An empty benchmark leaves all
texts. An empty table gives an empty result. Other columns are kept; input
columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from paywarden.llm.storage import saved
from paywarden.llm.text_arrays import FOLDED, NOT_ALNUM, Words, mixed, slices, words_in

MASKS = ("111111", "1101100011", "11010010011", "10110010101")
MIN_OVERLAP = 13
MIN_ITEM = 5
MIN_MATCHED = 0.8
BLOCK_WORDS = 2_000_000
MASK_GROUPS = 5
HIT_PAIRS = 1 << 20


def mask_positions(mask: str) -> list[int]:
    return [i for i, bit in enumerate(mask) if bit == "1"]


def short_masks(size: int) -> list[str]:
    """Masks of ``size`` words that hit an item of that size whichever words the share allows differ.

    The positions are dealt to ``MASK_GROUPS`` groups, and every choice of as
    many groups as words may differ is ignored by one mask.
    """
    differing = int(size - np.ceil(MIN_MATCHED * size))
    chosen = combinations(range(MASK_GROUPS), differing)
    return ["".join("0" if i % MASK_GROUPS in ignored else "1" for i in range(size)) for ignored in chosen]


def seeds(words: Words, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs inside one text under the mask, and the first word of each."""
    n = len(words.hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.full(n, len(mask), np.uint64)
    for k in mask_positions(mask):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k : k + n]
    owner = words.owner
    at = np.flatnonzero(owner[:n] == owner[len(mask) - 1 :])
    return mixed(hashes[at]), at


class Block:
    """Items of the benchmark with the seeds of all masks, in order of their hashes."""

    def __init__(self, ids: list[int | None], texts: list[str]) -> None:
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        sizes = [len(text.encode()) for text in texts]
        words = words_in(data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), NOT_ALNUM, FOLDED)
        self.ids = ids
        self.words = words.hashes
        self.first = words.first
        self.owner = words.owner
        counts = words.counts
        shorter = sorted({int(n) for n in counts if MIN_ITEM <= n < MIN_OVERLAP})
        self.masks = [*MASKS, *(mask for n in shorter for mask in short_masks(n))]
        found = []
        for number, mask in enumerate(self.masks):
            hashes, at = seeds(words, mask)
            size = counts[self.owner[at]]
            meant = size >= MIN_OVERLAP if number < len(MASKS) else size == len(mask)
            found.append((hashes[meant], at[meant], np.full(meant.sum(), number)))
        hashes, at, number = (np.concatenate(parts) for parts in zip(*found))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.at, self.number = hashes[order], at[order], number[order]
        # One bit per hash prefix: most runs of a text are sorted out by it.
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    @classmethod
    def of(cls, state: dict) -> Block:
        """The block with the arrays of another one; a broadcast carries the arrays alone."""
        block = cls.__new__(cls)
        block.__dict__.update(state)
        return block

    def alignments(self, words: Words) -> np.ndarray:
        """Rows of text, item and shift (word of the text less word of the benchmark) with a common seed."""
        found = [np.empty((0, 3), np.int64)]
        held = 0
        for number, mask in enumerate(self.masks):
            hashes, at = seeds(words, mask)
            maybe = np.flatnonzero(self.bits[(hashes >> np.uint64(42)).astype(np.int64)])
            hashes, at = hashes[maybe], at[maybe]
            low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
            some = np.flatnonzero(high > low)
            at, low, total = at[some], low[some], np.concatenate([[0], np.cumsum(high[some] - low[some])])
            first = 0
            while first < len(at):
                end = max(int(np.searchsorted(total, total[first] + HIT_PAIRS, "right")) - 1, first + 1)
                each = np.diff(total[first : end + 1])
                place = np.arange(total[first], total[end]) + np.repeat(low[first:end] - total[first:end], each)
                same = self.number[place] == number
                ours, place = np.repeat(at[first:end], each)[same], place[same]
                found.append(self.aligned(words, ours, self.at[place]))
                held += len(found[-1])
                if held > HIT_PAIRS:
                    found = [np.unique(np.concatenate(found), axis=0)]
                    held = 0
                first = end
        return np.unique(np.concatenate(found), axis=0)

    def aligned(self, words: Words, ours: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Text, item and shift of the seeds that start at these words, those of one alignment once."""
        shift = ours - theirs
        order = np.lexsort((ours, shift))
        rows = np.stack([words.owner[ours], self.owner[theirs], shift], 1)[order]
        return rows[np.concatenate([[True], (np.diff(rows, axis=0) != 0).any(1)])] if len(rows) else rows

    def overlaps(self, words: Words) -> Iterator[tuple[int, int | None, int, int]]:
        """Text, item, first word and word count of each verified overlap."""
        for text, which, by in self.alignments(words):
            first = max(words.first[text], self.first[which] + by)
            end = min(words.first[text + 1], self.first[which + 1] + by)
            same = words.hashes[first:end] == self.words[first - by : end - by]
            window = int(min(MIN_OVERLAP, self.first[which + 1] - self.first[which]))
            starts = matched_windows(same, window)
            if not len(starts):
                continue
            apart = np.flatnonzero(np.diff(starts) >= window)
            for start, last in zip(starts[np.concatenate([[0], apart + 1])], starts[np.concatenate([apart, [-1]])]):
                yield int(text), self.ids[which], int(first + start - words.first[text]), int(last + window - start)


def matched_windows(same: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows of which ``MIN_MATCHED`` match."""
    total = np.concatenate([[0], np.cumsum(same)])
    return np.flatnonzero(total[window:] - total[:-window] >= MIN_MATCHED * window)


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks of bounded size, read from the benchmark one partition at a time."""
    ids: list[int | None] = []
    texts: list[str] = []
    size = 0
    for row in benchmark.select("item_id", "text").dropna(subset="text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"]) // 2 + 1  # words at most
        if size >= block_words:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block(ids, texts)


FOUND = ("items", "starts", "lengths")


def with_overlaps(found: DataFrame, shared: Broadcast) -> DataFrame:
    """``found`` with the overlaps of each row with the block added to its ``items``, ``starts`` and ``lengths``."""
    others = [name for name in found.columns if name not in FOUND]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block.of(shared.value)
        for batch in batches:
            lists = [batch.column(name).to_pylist() for name in FOUND]
            for first, _, data, offsets in slices(batch.column("text")):
                words = words_in(data, offsets, NOT_ALNUM, FOLDED)
                for text, *overlap in held.overlaps(words):
                    for column, value in zip(lists, overlap):
                        column[first + text].append(value)
            arrays = [pa.array(column, pa.list_(pa.int64())) for column in lists]
            kept = [batch.column(name) for name in others]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], [*others, *FOUND])

    quoted = [f"`{name}`" for name in (*others, *FOUND)]
    return found.mapInArrow(scan, found.select(*quoted).schema)


def through_blocks(docs: DataFrame, benchmark: DataFrame, block_words: int, step) -> DataFrame:
    """``step`` of ``docs`` and every block in turn; what a block leaves is written before the next is read."""
    shared = None
    for block in benchmark_blocks(benchmark, block_words):
        if shared is not None:
            docs = saved(docs, "decontamination")
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))
        docs = step(docs, shared)
    return docs


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``items``, ``starts`` and ``lengths`` of each row's overlaps with all items."""
    none = F.array().cast(ArrayType(LongType()))
    found = docs.drop(*FOUND).withColumns({column: none for column in FOUND})
    return through_blocks(found, benchmark, block_words, with_overlaps)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` without any overlap, with the columns of ``docs``."""
    return through_blocks(
        docs, benchmark, block_words, lambda rows, shared: rows.mapInArrow(clean_rows(shared), rows.schema)
    )


def clean_rows(shared: Broadcast):
    """A function for ``mapInArrow`` that keeps the rows without an overlap."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block.of(shared.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for first, _, data, offsets in slices(batch.column("text")):
                words = words_in(data, offsets, NOT_ALNUM, FOLDED)
                clean[[first + text for text, *_ in held.overlaps(words)]] = False
            yield batch.filter(pa.array(clean))

    return keep
