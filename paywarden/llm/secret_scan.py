"""Secret scans through nested encodings.

A worklist starts with the text. Every layer is scanned for secrets, and what
it holds encoded becomes further layers: percent escapes, Unicode and character
escapes, escapes of quoted strings, base64 runs (wrapped at any width from
``MIN_RUN`` on, indented or not), and compressed bytes anywhere in any of them. Layers are taken
until none is left; a layer that was seen before at the same place is not taken
again, so an encoding that contains itself ends. Each layer knows which code
points of the text every one of its characters comes from, and the spans found
in it are given in the text.

A base64 run is decoded at each of its four alignments, so it may stand behind
or before other characters of its alphabet. Bytes that are no UTF-8 stay in a
layer as one character each, next to what is valid; UTF-16 is read wherever it
stands in a layer.

A compressed stream may begin at any place of a layer, whose characters are
taken as the bytes of their UTF-8 and, below 256, as bytes themselves. All
members of a stream are expanded, together up to ``MAX_LAYER_BYTES``; a larger
one, which no bounded memory can hold, is counted in ``n_closed`` and read in
overlapping pieces. A stream that ends properly is read once. Those that break
off may together read ``SPARE_FACTOR`` times the layer (``SPARE_BYTES`` at
least), so time grows with the size of hostile texts; beyond that only the
first ``PROBE`` bytes of a stream are read, and the layer is counted in
``n_closed``.

Nulls: a null text is an empty one and has no spans; a null id is kept.
Repeated rows are scanned alike. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

MAX_LAYER_BYTES = 64 << 20
PIECE_BYTES = 4 << 20
OVERLAP_BYTES = 1 << 20
MIN_RUN = 16
PROBE = 1 << 10
SPARE_FACTOR = 64
SPARE_BYTES = 1 << 22

# The kinds of secrets in their order, the names of assigned
# secrets, and the least sizes.
KINDS = ("assign", "access", "hex")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # a shorter run is no match and overlaps none
# One of these stands in every assigned secret's name.
_NAMES = ("passw", "secret", "token", "api")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}" % MIN_RUN)
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{%d,}+[ \t]*+\r?\n[ \t]*+)+[A-Za-z0-9+/_-]++={0,2}" % MIN_RUN
)
_STRING = re.compile(r"""\\(?:["'\\/bfnrt0]|u[0-9A-Fa-f]{4}|x[0-9A-Fa-f]{2})""")
_SIMPLE = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "0": "\0"}
_CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
# The shortest secret, and any text that encodes one, has so many ASCII characters in a row, of one or two bytes.
_ASCII = re.compile(rb"[\t\n\r -~]{12}|(?:[\t\n\r -~]\x00){11}|(?:\x00[\t\n\r -~]){11}")
# Characters of UTF-16 of one byte, either byte first; a byte order mark is not one of them.
_WIDE = re.compile(r"(?:\x00[^\x00]){4,}|(?:[^\x00\udcff]\x00){4,}")
# How gzip, bz2, xz and zlib streams begin, as bytes and in a layer, where bytes that are no UTF-8 are U+DC80 to U+DCFF.
_HEADS = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
_HEAD = re.compile(
    "\x1f[\x8b\udc8b]\x08|BZh[1-9](?:1AY&SY|\x17rE8P[\x90\udc90])|[\xfd\udcfd]7zXZ\0|x[\x01^\x9c\xda\udc9c\udcda\u0680-\u06bf]"
)
_LONE = re.compile("[\ud800-\udc7f\udd00-\udfff]")
_BROKEN = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)

Span = tuple[int, int, int]  # start, kind, end


@dataclass
class Layer:
    """A decoded text; character ``i`` comes from code points ``starts[i]`` to ``ends[i]`` of the document."""

    text: str
    starts: np.ndarray | None = None  # None: the document itself
    ends: np.ndarray | None = None
    searched: bool = False  # whether streams were looked for in its bytes before

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])


def secrets_in(text: str) -> Iterator[tuple[int, int, int]]:
    """Start, kind and end of the secrets of one layer."""
    lower = text.lower()
    if any(name in lower for name in _NAMES):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= MIN_ASSIGNED:
                yield match.start(), 0, match.end()
    if "AKIA" in text:
        for match in _ACCESS.finditer(text):
            if len(match[0]) >= MIN_ACCESS:
                yield match.start(), 1, match.end()
    for match in _HEX.finditer(text):
        yield match.start(), 2, match.end()


def opened(data: bytes):
    """A decompressor for the stream that ``data`` begins with, None if it is none."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and data[1:2] in (b"\x01", b"\x5e", b"\x9c", b"\xda"):
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


class Stream:
    """The members of a compressed stream that begins at ``start`` of ``data``.

    ``end`` is where reading has come to, and ``whole`` whether the last member
    has ended properly. Input is fed in growing parts, so a short member costs
    its own size, wherever it stands.
    """

    def __init__(self, data: bytes, start: int = 0, limit: int | None = None) -> None:
        self.data, self.end, self.whole = data, start, False
        self.limit = len(data) if limit is None else min(len(data), start + limit)

    def pieces(self) -> Iterator[bytes]:
        while (member := opened(self.data[self.end : min(self.end + 8, self.limit)])) is not None:
            self.whole = False
            try:
                yield from self.member(member)
            except _BROKEN:
                return
            if not member.eof:
                return
            self.whole = True
            self.end -= len(member.unused_data)
            after = self.end
            while after < self.limit and not self.data[after]:
                after += 1
            if opened(self.data[after : min(after + 8, self.limit)]) is None:
                return
            self.end = after

    def member(self, member) -> Iterator[bytes]:
        zipped, feed = not hasattr(member, "needs_input"), PROBE
        while not member.eof and self.end < self.limit:
            given = self.data[self.end : min(self.end + feed, self.limit)]
            self.end += len(given)
            feed = min(2 * feed, PIECE_BYTES)
            more = True
            while more and not member.eof:
                out = member.decompress(given, PIECE_BYTES)
                given = member.unconsumed_tail if zipped else b""
                more = bool(given) or len(out) == PIECE_BYTES or not (zipped or member.needs_input)
                if out:
                    yield out


def expanded(data: bytes) -> bytes | None:
    """The bytes in a compressed stream, ``data`` itself if it is none, None if they exceed the limit."""
    found, size = [], 0
    for piece in Stream(data).pieces():
        size += len(piece)
        if size > MAX_LAYER_BYTES:
            return None
        found.append(piece)
    return b"".join(found) if found else data


def text_of(data: bytes) -> str:
    """UTF-8 text; a byte that is not valid is a character of its own."""
    return data.decode("utf-8", "surrogateescape")


def byte_edges(text: str) -> np.ndarray:
    """The first byte of each character of ``text_of``, and the end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    sizes[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    return np.concatenate([[0], np.cumsum(sizes)])


def plain(data: bytes) -> bool:
    """Whether all is text without control characters."""
    try:
        return not _CONTROL.search(data.decode())
    except UnicodeDecodeError:
        return False


class Scan:
    """The worklist of one document."""

    def __init__(self, text: str) -> None:
        self.spans: set[Span] = set()
        self.base = sorted(secrets_in(text))
        self.layers = 0
        self.closed = 0
        self.seen: set[tuple[bytes, int, int]] = set()
        self.work = [Layer(text)]
        self.spans.update(self.base)
        self.drain()

    def drain(self) -> None:
        while self.work:
            layer = self.work.pop()
            if layer.starts is not None:
                self.layers += 1
                for start, kind, end in secrets_in(layer.text):
                    first, last = layer.place(start, end)
                    self.spans.add((first, kind, last))
            self.unwrap(layer)

    def push(self, layer: Layer) -> None:
        if not layer.text:
            return
        digest = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        key = (digest, int(layer.starts[0]), int(layer.ends[-1]))
        if key not in self.seen:
            self.seen.add(key)
            self.work.append(layer)

    def unwrap(self, layer: Layer) -> None:
        text = layer.text
        if "%" in text and _PERCENT.search(text):
            self.replace(layer, _PERCENT, self.percent)
        if ("\\" in text or "&#" in text) and _ESCAPE.search(text):
            self.replace(layer, _ESCAPE, self.escape)
        if "\\" in text and _STRING.search(text):
            self.replace(layer, _STRING, self.string)
        if "\0" in text:
            self.replace(layer, _WIDE, self.wide)
        if _HEAD.search(text):
            self.packed(layer)
        runs = [match.span() for match in _RUN.finditer(text)]
        if runs and "\n" in text:
            runs += [match.span() for match in _WRAPPED.finditer(text)]
        for start, end in runs:
            self.base64(layer, start, end)

    def replace(self, layer: Layer, pattern: re.Pattern, decode) -> None:
        """One layer with all matches of ``pattern`` decoded in place."""
        pieces: list[str] = []
        spots: list[np.ndarray] = []
        at = 0

        def keep(start: int, end: int) -> None:
            pieces.append(layer.text[start:end])
            here = np.arange(start, end)
            spots.append(np.stack([here, here + 1]))

        for match in pattern.finditer(layer.text):
            decoded = decode(layer, match)
            if decoded is None:
                continue
            keep(at, match.start())
            part, starts, ends = decoded
            pieces.append(part)
            spots.append(np.stack([np.array(starts, np.int64), np.array(ends, np.int64)]))
            at = match.end()
        if at:
            keep(at, len(layer.text))
            starts, ends = np.concatenate(spots, axis=1)
            self.push(self.mapped(layer, "".join(pieces), starts, ends))

    def mapped(self, layer: Layer, text: str, starts: np.ndarray, ends: np.ndarray) -> Layer:
        if layer.starts is not None:
            starts, ends = layer.starts[starts], layer.ends[ends - 1]
        return Layer(text, starts, ends)

    def percent(self, layer: Layer, match: re.Match) -> tuple[str, np.ndarray, np.ndarray]:
        part = text_of(bytes.fromhex(match[0].replace("%", "")))
        edges = match.start() + 3 * byte_edges(part)
        return part, edges[:-1], edges[1:]

    def escape(self, layer: Layer, match: re.Match) -> tuple[str, list[int], list[int]] | None:
        *hexadecimal, decimal = match.groups()
        code = int(decimal) if decimal else int(next(group for group in hexadecimal if group), 16)
        return (chr(code), [match.start()], [match.end()]) if code < 0x110000 else None

    def wide(self, layer: Layer, match: re.Match) -> tuple[str, np.ndarray, np.ndarray]:
        """UTF-16 as its characters of one byte."""
        starts = np.arange(match.start(), match.end(), 2)
        return match[0].replace("\0", ""), starts, starts + 2

    def string(self, layer: Layer, match: re.Match) -> tuple[str, list[int], list[int]]:
        """A character that a quoted string escapes."""
        code = match[0][1:]
        char = chr(int(code[1:], 16)) if len(code) > 1 else _SIMPLE.get(code, code)
        return char, [match.start()], [match.end()]

    def packed(self, layer: Layer) -> None:
        """Compressed streams in the characters of a layer, taken as UTF-8 and as bytes."""
        text = _LONE.sub("?", layer.text)
        if text.isascii():
            if not layer.searched:
                self.compressed(text.encode(), layer.place)
            return
        data, edges = text.encode("utf-8", "surrogateescape"), byte_edges(text)

        def characters(start: int, end: int) -> tuple[int, int]:
            first, last = np.searchsorted(edges, [start, end - 1], "right")
            return layer.place(int(first) - 1, int(last))

        if not layer.searched:
            self.compressed(data, characters)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if ((codes >= 0x80) & (codes < 0x100)).any():
            codes = np.where((codes >= 0xDC80) & (codes <= 0xDCFF), codes - 0xDC00, codes)
            self.compressed(np.where(codes < 0x100, codes, 0).astype(np.uint8).tobytes(), layer.place)

    def compressed(self, data: bytes, place: Callable[[int, int], tuple[int, int]]) -> None:
        """Take what the compressed streams in ``data`` hold as layers; ``place`` is where bytes stand in the text."""
        spare, at, closed = max(SPARE_BYTES, SPARE_FACTOR * len(data)), 0, False
        while (head := _HEADS.search(data, at)) is not None:
            start = head.start()
            stream = Stream(data, start, None if spare > 0 else PROBE)
            self.expand(stream, start, place)
            at = stream.end if stream.whole else start + 1
            if not stream.whole:
                closed |= spare <= 0 and stream.end == stream.limit < len(data)
                spare -= stream.end - start
        self.closed += closed

    def expand(self, stream: Stream, start: int, place: Callable[[int, int], tuple[int, int]]) -> None:
        """A layer of what ``stream`` holds, or overlapping ones if it is too large for one."""
        held, size, large = [], 0, False
        for piece in stream.pieces():
            held.append(piece)
            size += len(piece)
            large |= size > MAX_LAYER_BYTES
            if large:
                self.pieces_of(b"".join(held), *place(start, stream.end))
                held = [b"".join(held)[-OVERLAP_BYTES:]]
        if large:
            self.closed += 1
        elif held:
            self.push_bytes(b"".join(held), *place(start, stream.end))

    def pieces_of(self, data: bytes, first: int, last: int) -> None:
        for at in range(0, max(len(data) - OVERLAP_BYTES, 1), PIECE_BYTES):
            self.push_bytes(data[at : at + PIECE_BYTES + OVERLAP_BYTES], first, last)
            self.drain()

    def push_bytes(self, data: bytes, first: int, last: int) -> None:
        """A layer of which every character comes from the same place."""
        text = text_of(data)
        self.push(Layer(text, np.broadcast_to(np.int64(first), len(text)), np.broadcast_to(np.int64(last), len(text))))

    def base64(self, layer: Layer, start: int, end: int) -> None:
        run = layer.text[start:end]
        places = np.array([i for i, c in enumerate(run) if c not in "=\r\n\t "], np.int64) if "\n" in run else None
        digits = re.sub(r"[=\r\n\t ]", "", run).translate({45: 43, 95: 47})

        def bytes_from(first: int) -> bytes:
            some = digits[first:]
            some = some[: len(some) - (len(some) % 4 == 1)]
            return base64.b64decode(some + "=" * (-len(some) % 4))

        for shift in range(4):
            data = bytes_from(shift)

            def digits_of(first: int, last: int, shift: int = shift, size: int = len(data)) -> tuple[int, int]:
                span = np.array([shift + 8 * first // 6, shift + (8 * last - 1) // 6])
                span = span if places is None else places[span]
                return layer.place(start + int(span[0]), end if last == size else start + int(span[1]) + 1)

            self.compressed(data, digits_of)
            if not _ASCII.search(data) and (shift or not plain(data)):
                continue
            text = text_of(data)
            # Character by character, the sextets that its bytes touch.
            edges = byte_edges(text)
            first, last = shift + 8 * edges[:-1] // 6, shift + (8 * edges[1:] - 1) // 6
            if places is not None:
                first, last = places[first], places[last]
            decoded = self.mapped(layer, text, start + first, start + last + 1)
            decoded.searched = True
            self.push(decoded)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


FIELDS = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_closed")


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            scan = Scan(value.as_py() or "")
            counts = [sum(kind == k for _, kind, _ in scan.base) for k in range(len(KINDS))]
            digest = hashlib.sha256(written(scan.base).encode()).hexdigest()
            rows.append((*counts, digest, written(sorted(scan.spans)), scan.layers, scan.closed))
        columns = [list(column) for column in zip(*rows)] or [[] for _ in FIELDS]
        kinds = [pa.string() if name in ("base_sha256", "spans") else pa.int64() for name in FIELDS]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *FIELDS])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Counts and digest of the plain secrets of each row, and ``spans`` of all, decoded ones included."""
    given = docs.select("doc_id", "text")
    kinds = [StringType() if name in ("base_sha256", "spans") else LongType() for name in FIELDS]
    fields = [StructField(name, kind) for name, kind in zip(FIELDS, kinds)]
    return given.mapInArrow(scan_batches, StructType([given.schema["doc_id"], *fields]))
