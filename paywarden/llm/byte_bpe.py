"""Byte-level BPE encoding and decoding as a monoid: halves are encoded, then joined.

A text is cut into halves down to ``LEAF_CHARS`` characters. Two neighbours are
joined by matching the pattern again around the cut, in a window that grows
until it meets a place that provably is a boundary in the whole:

* The pattern looks at no character before a match and at ``LOOKAHEAD`` after
  it at most. So the matches of the left half that end that far before the cut
  stay, and from the first new match boundary that the right half has, too,
  all matches of the right half stay.

Each match is encoded alone, and long ones by halves again, down to
``LEAF_BYTES`` bytes. Two neighbours are joined by encoding the tokens around
the cut again, in a window that grows until both its ends are stable:

* Tokens are the encoding of their bytes exactly if each two neighbours are the
  encoding of the bytes of both, as the first merge across a boundary would
  need nothing but the two tokens beside it. So the tokens outside the window
  stay once the pairs at its ends hold.

Decoding joins the bytes of halves of the ids.

Nulls: a null text is encoded like an empty one, to no ids. A null list of ids
gives no bytes. Rows are encoded one by one, so repeated rows, null ids and
an empty table need no rule. Texts are encoded whole; one is held by one task.
An id that the vocabulary lacks fails the job. Other columns are kept, but
those named ``ids`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from paywarden.llm.text_arrays import slices

LEAF_CHARS = 2048
LEAF_BYTES = 5
LEAF_IDS = 4096
LOOKAHEAD = 2
WINDOW_CHARS = 32
# Above this length the lowest rank is kept in a heap instead of being looked for.
SCANNED_BYTES = 256
# Newest entries that a task keeps of what it has met; as many older ones stay beside them.
KEPT = 250_000

ROWS_DECODED = 64

NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line is a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Kept(dict):
    """Values by key, made when missing; at most ``limit`` new ones and as many older ones are held."""

    def __init__(self, make, limit: int = KEPT) -> None:
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """A vocabulary with the pattern that cuts its words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.words = Kept(lambda word: pack(self.encode_word(word)))
        self.leaves = Kept(self.merged)
        self.pairs = Kept(self.changed)
        ids = np.array(sorted(self.tokens), np.int64)
        sizes = np.zeros(ids[-1] + 1 if len(ids) else 0, np.int64)
        sizes[ids] = [len(self.tokens[i]) for i in ids]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.bytes = np.frombuffer(b"".join(self.tokens[i] for i in ids), np.uint8)

    # Bytes of one match

    def merged(self, data: bytes) -> list[int]:
        """The ids of ``data`` by merging the pair of lowest rank, the leftmost of equal ones."""
        if len(data) > SCANNED_BYTES:
            return self.merged_by_heap(data)
        rank_of = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [rank_of(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            lowest = min(ranks)
            if lowest == NEVER:
                break
            i = ranks.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] + parts[i + 1], NEVER)
        return [self.ranks[part] for part in parts]

    def merged_by_heap(self, data: bytes) -> list[int]:
        n, rank_of = len(data), self.ranks.get
        end = list(range(1, n + 1))  # of the part that starts here; 0 once it is part of another
        before = list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(start: int) -> None:
            middle = end[start]
            if middle < n and (rank := rank_of(data[start : end[middle]])) is not None:
                heapq.heappush(heap, (rank, start, middle, end[middle]))

        for start in range(n):
            offer(start)
        while heap:
            _, start, middle, stop = heapq.heappop(heap)
            if end[start] != middle or end[middle] != stop:
                continue
            end[start], end[middle] = stop, 0
            if stop < n:
                before[stop] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        ids, start = [], 0
        while start < n:
            ids.append(self.ranks[data[start : end[start]]])
            start = end[start]
        return ids

    def changed(self, pair: tuple[int, int]) -> list[int] | bool:
        """What two tokens are encoded to together, False if that is the two."""
        ids = self.merged(self.tokens[pair[0]] + self.tokens[pair[1]])
        return ids != [*pair] and ids

    def joined_tokens(self, left: list[int], right: list[int]) -> list[int]:
        size, pairs = 1, self.pairs
        middle = pairs[left[-1], right[0]]
        if not middle:
            return left + right
        while (size < len(left) and pairs[left[-size - 1], middle[0]]) or (
            size < len(right) and pairs[middle[-1], right[size]]
        ):
            size *= 2
            middle = self.merged(b"".join(map(self.tokens.__getitem__, left[-size:] + right[:size])))
        return left[:-size] + middle + right[size:]

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.leaves[data]
        middle = len(data) // 2
        return self.joined_tokens(self.encode_bytes(data[:middle]), self.encode_bytes(data[middle:]))

    def encode_word(self, word: str) -> list[int]:
        data = word.encode()
        known = self.ranks.get(data)
        return self.encode_bytes(data) if known is None else [known]

    # Matches of a text

    def matches(self, text: str, start: int, end: int) -> list[str]:
        """The matches of a part of a text, taken by itself."""
        if end - start <= LEAF_CHARS:
            return self.pattern.findall(text, start, end)
        cut = (start + end) // 2
        return self.joined_matches(text, self.matches(text, start, cut), self.matches(text, cut, end), cut, end)

    def joined_matches(self, text: str, left: list[str], right: list[str], cut: int, end: int) -> list[str]:
        at = cut
        while left and at > cut - LOOKAHEAD:
            at -= len(left.pop())
        window = WINDOW_CHARS
        while True:
            stop = min(end, cut + window)
            middle, here, k, there = [], at, 0, cut
            for match in self.pattern.finditer(text, at, stop):
                if match.end() > stop - LOOKAHEAD and stop < end:
                    break  # may be longer in the whole
                middle.append(match[0])
                here = match.end()
                while there < here and k < len(right):
                    there += len(right[k])
                    k += 1
                if here == there:
                    return left + middle + right[k:]
            if stop == end:
                return left + middle
            window *= 2

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, packed."""
        return b"".join(map(self.words.__getitem__, self.matches(text, 0, len(text))))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) > LEAF_IDS:
            middle = len(ids) // 2
            return self.decode(ids[:middle]) + self.decode(ids[middle:])
        sizes = self.sizes[ids]
        if not sizes.all():
            raise ValueError("an id is not in the vocabulary")
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)
        return self.bytes[at].tobytes()


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """``batch`` with ``values`` as its last column, instead of one of that name."""
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), values], [*kept, name])


def result_schema(df: DataFrame, name: str, kind: str) -> str:
    kept = (f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name)
    return ", ".join([*kept, f"`{name}` {kind}"])


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids``, the tokens of the column ``text``; the vocabulary, a fixed small table, goes to all tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, pattern)
        for batch in batches:
            for first, end, _, _ in slices(batch.column(text)):
                part = batch.slice(first, end - first)
                packed = [codec.encode(t or "") for t in part.column(text).to_pylist()]
                flat = np.frombuffer(b"".join(packed), np.int32)
                offsets = np.cumsum([0, *(len(ids) // 4 for ids in packed)]).astype(np.int32)
                yield with_column(part, "ids", pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))

    return docs.mapInArrow(encode, result_schema(docs, "ids", "array<int>"))


def decode_ids(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``decoded``, the bytes of the column ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, "")
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_DECODED):
                part = batch.slice(first, ROWS_DECODED)
                lists = part.column("ids")
                ids, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(lists).fill_null(0))
                found = [codec.decode(own) for own in np.split(ids, ends[:-1])]
                yield with_column(part, "decoded", pa.array(found, pa.binary()))

    return encoded.mapInArrow(decode, result_schema(encoded, "decoded", "binary"))
