"""Operator 1, secret scan with a recursive decoding worklist.

Every text is scanned as it is, and again behind each layer that encodes
part of it: URL escapes, Unicode escapes and character references, base64 and
compressed data of any number of members, and ASCII text in UTF-16 or UTF-32.
Bytes that are no UTF-8 are read as Latin-1: all patterns are ASCII.  A
worklist unwraps layer after layer until nothing new comes out; a layer met
before (same content at the same place) is not unwrapped again.  Each layer carries, for each of its characters, the range of
the original text that it came from, so that a find maps back to a span there.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from matchday.llm.common import document_columns

# fixed values of the result: kinds in their order, patterns and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6

#: a decompressed layer larger than this is counted and read as a stream of
#: blocks (a quarter of it, half a block of overlap), so that a decompression
#: bomb takes time but no memory; all other layers are read in one piece (and
#: all layers are if the limit is None)
MAX_LAYER = 64 << 20
MIN_BLOCK = 1 << 16
#: a decompressor gives at most so many bytes at once
PIECE = 1 << 20

_URL = re.compile(r"%[0-9A-Fa-f]{2}")
_ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|%u([0-9A-Fa-f]{4})"
)
#: ASCII text in UTF-16 or UTF-32 of either byte order
_WIDE = re.compile(r"[\t\r\n -~](?:(?:\0[\t\r\n -~]){5,}|(?:\0{3}[\t\r\n -~]){5,})")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
_BASE64_URL = re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")
#: lines of base64, broken by line ends or by escaped ones
_BREAK = re.compile(r"\r?\n|(?:\\r)?\\n")
_BASE64_LINES = re.compile(r"[A-Za-z0-9+/]{16,}(?:(?:\r?\n|(?:\\r)?\\n)[A-Za-z0-9+/]+)+={0,2}")

#: the first bytes of compressed data, with some of them escaped, to the end of the word or quotation
_URL_PACKED = re.compile(
    r"(?:%1[fF]%8[bB]|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA])|BZh[1-9]1AY|%[fF][dD]7zXZ%00|(?:\(|%28)%[bB]5(?:/|%2[fF])%[fF][dD])[!-~]*"
)
_ESCAPE_PACKED = re.compile(
    r"(?:\\x1f\\x8b|(?:x|\\x78)\\x(?:01|5e|9c|da)|\\xfd7zXZ\\x00|(?:\(|\\x28)\\xb5(?:/|\\x2f)\\xfd)[ -~]*"
)


@dataclass
class Layer:
    """Decoded characters and, per character, the original range [start, end)."""

    text: str
    start: np.ndarray
    end: np.ndarray
    part: bool = False  # a block of a larger layer


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the finds in a text as it is, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _decode_bytes(data: bytes, start: np.ndarray, end: np.ndarray) -> Layer | None:
    """UTF-8 bytes with their ranges as a layer; None unless it is text."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    if start.strides == (0,):  # all from one range
        n = len(text)
        return Layer(text, np.broadcast_to(start[:1], n), np.broadcast_to(end[:1], n)) if n else None
    lead = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    if not len(lead):
        return None
    last = np.append(lead[1:], len(data)) - 1
    return Layer(text, start[lead], end[last])


def _splice(layer: Layer, parts: list[tuple[int, int, Layer]]) -> Layer:
    """The layer with the ranges (from, to) replaced by decoded pieces."""
    text, starts, ends, at = [], [], [], 0
    for a, b, piece in parts:
        text += [layer.text[at:a], piece.text]
        starts += [layer.start[at:a], piece.start]
        ends += [layer.end[at:a], piece.end]
        at = b
    text.append(layer.text[at:])
    starts.append(layer.start[at:])
    ends.append(layer.end[at:])
    return Layer("".join(text), np.concatenate(starts), np.concatenate(ends))


_URL_BYTE = re.compile(r"%([0-9A-Fa-f]{2})|(.)", re.DOTALL)
_LITERAL_BYTE = re.compile(r"\\x([0-9A-Fa-f]{2})|\\([nrt\\'\"])|(.)", re.DOTALL)
_LETTERS = {"n": 10, "r": 13, "t": 9}


def _packed_bytes(text: str, pattern: re.Pattern) -> tuple[bytes, list[int]]:
    """Bytes of a partly escaped ASCII text, and where each ends in it."""
    data, ends = bytearray(), []
    for m in pattern.finditer(text):
        if m.group(1):
            data.append(int(m.group(1), 16))
        elif len(m.group()) == 2:
            data.append(_LETTERS.get(m.group(2)) or ord(m.group(2)))
        else:
            data.append(ord(m.group()))
        ends.append(m.end())
    return bytes(data), ends


def _runs(matches: list[re.Match]) -> list[list[re.Match]]:
    out: list[list[re.Match]] = []
    for m in matches:
        if out and out[-1][-1].end() == m.start():
            out[-1].append(m)
        else:
            out.append([m])
    return out


def _unescape(layer: Layer, decompressed) -> Iterator:
    """URL and Unicode escapes undone in place, each kind once; runs of
    escapes that are no text are tried as compressed data."""
    if "%" in layer.text and (matches := list(_URL.finditer(layer.text))):
        parts = []
        for run in _runs(matches):
            a, b = run[0].start(), run[-1].end()
            data = bytes(int(m.group()[1:], 16) for m in run)
            first = np.array([layer.start[m.start()] for m in run])
            last = np.array([layer.end[m.end() - 1] for m in run])
            piece = _decode_bytes(data, first, last)
            if piece is None:
                if is_packed(data):
                    yield decompressed(data, int(layer.start[a]), int(layer.end[b - 1]))
                # bytes of another encoding: one character each
                piece = Layer(data.decode("latin-1"), first, last)
            parts.append((a, b, piece))
        yield _splice(layer, parts)
    if ("\\" in layer.text or "&#" in layer.text or "%u" in layer.text) and (matches := list(_ESCAPE.finditer(layer.text))):
        parts = []
        for run in _runs(matches):
            codes = [int(next(g for g in m.groups()[:5] if g), 16) if any(m.groups()[:5]) else int(m.group(6)) if m.group(6) else int(m.group(7), 16) for m in run]
            first = np.array([layer.start[m.start()] for m in run])
            last = np.array([layer.end[m.end() - 1] for m in run])
            if all(c < 256 for c in codes) and any(c >= 128 for c in codes):  # bytes
                data = bytes(codes)
                if is_packed(data):
                    yield decompressed(data, int(first[0]), int(last[-1]))
                piece = _decode_bytes(data, first, last)
                if piece is not None:
                    parts.append((run[0].start(), run[-1].end(), piece))
                    continue
            chars, starts, ends, i = [], [], [], 0
            while i < len(codes):
                c, k = codes[i], 1
                if 0xD800 <= c < 0xDC00 and i + 1 < len(codes) and 0xDC00 <= codes[i + 1] < 0xE000:
                    c, k = 0x10000 + ((c - 0xD800) << 10) + codes[i + 1] - 0xDC00, 2
                chars.append(chr(c) if c < 0x110000 and not 0xD800 <= c < 0xE000 else "\ufffd")
                starts.append(first[i])
                ends.append(last[i + k - 1])
                i += k
            parts.append((run[0].start(), run[-1].end(), Layer("".join(chars), np.array(starts), np.array(ends))))
        yield _splice(layer, parts)


def _even_lines(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    """Stretches of the lines in text[a:b] that are equally wide but for a
    shorter last one; the first may have other letters in front."""
    lines, at = [], a
    for m in _BREAK.finditer(text, a, b):
        lines.append((at, m.start()))
        at = m.end()
    lines.append((at, b))
    i = 0
    while i + 1 < len(lines):
        start, end = lines[i]
        width = lines[i + 1][1] - lines[i + 1][0]
        body = len(text[lines[i + 1][0] : lines[i + 1][1]].rstrip("="))
        j = i + 1
        if i + 2 < len(lines) and body == width >= 16 and end - start >= width:  # full lines follow
            while j < len(lines) and lines[j][1] - lines[j][0] == width:
                j += 1
            if j < len(lines) and lines[j][1] - lines[j][0] < width:
                j += 1
            yield max(start, end - width), lines[j - 1][1]
        elif width <= end - start:  # two lines: the first is the full one
            j = i + 2
            yield start, lines[i + 1][1]
        i = j


def _is_text(data: bytes) -> bool:
    """Whether decoded bytes read as text: chance rarely makes such."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return False
    return all(c.isprintable() or c in "\t\r\n" for c in text)


_MAGIC = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
#: frames that zstandard skips (pzstd writes them before each frame)
_SKIPPED = tuple(bytes([0x50 + i]) + b"\x2a\x4d\x18" for i in range(16))


_BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError, MemoryError)


def _expand(head: bytes, source: Iterator[bytes]):
    """Content of the one compressed member that starts with ``head`` and
    goes on in ``source``, in pieces; returns the bytes read beyond its end,
    None if the input ends before the member does."""
    data = head
    if head.startswith((_MAGIC[3], *_SKIPPED)):
        box = zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj()
        while data:
            for i in range(0, len(data), 1024):  # 128 KB from 4 bytes at most
                if got := box.decompress(data[i : i + 1024]):
                    yield got
                if box.eof:
                    return box.unused_data + data[i + 1024 :]
            data = next(source, b"")
        return None
    if head.startswith((b"BZh", b"\xfd7zXZ")):
        box = bz2.BZ2Decompressor() if head.startswith(b"BZh") else lzma.LZMADecompressor()
        while data:
            if got := box.decompress(data, PIECE):
                yield got
            while not box.eof and not box.needs_input:
                if got := box.decompress(b"", PIECE):
                    yield got
            if box.eof:
                return box.unused_data
            data = next(source, b"")
        return None
    box = zlib.decompressobj(31 if head.startswith(b"\x1f\x8b") else 15)
    while data:
        while not box.eof:
            got = box.decompress(data, PIECE)
            data = box.unconsumed_tail
            if got:
                yield got
            if not data and len(got) < PIECE:
                break
        if box.eof:
            return box.unused_data
        data = next(source, b"")
    return None


class Members:
    """The content of gzip, zlib, bzip2, xz or zstandard data, in pieces, with
    all members that follow one another (zeros between them are padding).

    Afterwards ``rest`` is what follows the last member, as chunks, and
    ``used`` the number of bytes up to there; ``broken`` data has no rest."""

    def __init__(self, source: Iterable[bytes]):
        self._source = iter(source)
        self._read = self.used = 0
        self.rest: Iterator[bytes] = iter(())
        self.broken = False

    def _chunks(self) -> Iterator[bytes]:
        for chunk in self._source:
            if chunk:
                self._read += len(chunk)
                yield chunk

    def __iter__(self) -> Iterator[bytes]:
        chunks = self._chunks()
        data = b""
        while True:
            while len(data) < 6 and (more := next(chunks, b"")):
                data += more
                data = data.lstrip(b"\0") if self.used else data
            if not data.startswith((*_MAGIC, *_SKIPPED)):
                self.rest = chain([data] if data else [], chunks)
                return
            try:
                left = yield from _expand(data, chunks)
            except _BROKEN:
                self.broken = True
                return
            self.used = self._read - len(left or b"")
            if left is None:
                return
            data = left.lstrip(b"\0")


def is_packed(data: bytes) -> bool:
    """Whether the bytes start with compressed data that can be read."""
    return data.startswith((*_MAGIC, *_SKIPPED)) and next(iter(Members([data])), None) is not None


def packed_size(data: bytes) -> int:
    """How many of the bytes the compressed data at their start takes."""
    members = Members([data])
    for _ in members:
        pass
    return members.used if members.used and not members.broken else len(data)


class Scanner:
    """Finds of one text and, by the worklist, of all layers inside it."""

    def __init__(self, text: str, limit: int | None = MAX_LAYER):
        self.base = base_spans(text)
        self.spans = set(self.base)
        self.layers = self.oversize = 0
        limit = sys.maxsize if limit is None else limit
        self.limit, self.block = limit, max(limit // 4, MIN_BLOCK)
        self._seen: set[tuple[bytes, int, int]] = set()
        n = len(text)
        # what is open, the innermost last: a layer is done before its next sibling is made
        self._work: list[Iterator] = []
        if _may_hide(text):
            at = np.arange(n)
            self._work.append(self._unwrap(Layer(text, at, at + 1)))
        while self._work:
            inner = next(self._work[-1], None)
            if inner is None:
                self._work.pop()
            elif isinstance(inner, Layer):
                self._add(inner)
            else:
                self._work.append(inner)

    def _add(self, layer: Layer) -> None:
        if not layer.text:
            return
        mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), int(layer.start[0]), int(layer.end[-1]))
        if mark in self._seen:  # the same content at the same place: a cycle
            return
        self._seen.add(mark)
        self.layers += not layer.part
        for a, kind, b in base_spans(layer.text):
            self.spans.add((int(layer.start[a]), kind, int(layer.end[b - 1])))
        if _may_hide(layer.text):
            self._work.append(self._unwrap(layer))

    def _content(self, data: bytes, start: int, end: int) -> Iterator:
        """What compressed data holds, all of it mapped to one range."""
        mark = (hashlib.sha256(data).digest(), start, end)
        if mark in self._seen:
            return
        self._seen.add(mark)
        members = Members([data])
        yield self._stream(members, start, end)
        if tail := b"".join(members.rest):
            yield from self._reading(tail, np.full(len(tail), start), np.full(len(tail), end), True)

    def _stream(self, chunks: Iterable[bytes], start: int, end: int) -> Iterator:
        """Layers of decompressed data: one, or blocks if it is large."""
        chunks, head, size = iter(chunks), [], 0
        while size <= self.limit and (chunk := next(chunks, b"")):
            head.append(chunk)
            size += len(chunk)
        data = b"".join(head)
        if size <= self.limit:
            yield from self._reading(data, np.broadcast_to(start, size), np.broadcast_to(end, size), True)
            return
        self.oversize += 1
        self.layers += 1
        chunks = chain([data], chunks)
        if is_packed(data):  # compressed again
            del data, head
            members = Members(chunks)
            yield self._stream(members, start, end)
            chunks = members.rest
        else:
            del data, head
        block = bytearray()
        for chunk in chunks:
            block += chunk
            while len(block) >= self.block:
                yield self._part(block[: self.block], start, end)
                del block[: self.block // 2]
        yield self._part(block, start, end)

    def _part(self, data: bytearray, start: int, end: int) -> Layer:
        n = len(data)
        return Layer(data.decode("latin-1"), np.broadcast_to(start, n), np.broadcast_to(end, n), True)

    def _reading(self, data: bytes, start: np.ndarray, end: np.ndarray, sure: bool) -> Iterator:
        """Bytes as a layer: UTF-8, else one character each, and what they
        hold if they are compressed.  Bytes that are not ``sure`` to be
        meant, and do not read as text, must show a find or a further layer."""
        if not data:
            return
        packed = is_packed(data)
        if packed:
            yield self._content(data, int(start[0]), int(end[-1]))
        layer = _decode_bytes(data, start, end)
        if layer is None and not packed:
            layer = Layer(data.decode("latin-1"), start, end)
        if layer is not None and (sure or _is_text(data) or _may_hide(layer.text) or base_spans(layer.text)):
            yield layer

    def _unwrap(self, layer: Layer) -> Iterator:
        yield from _unescape(layer, self._content)
        for m in _WIDE.finditer(layer.text) if "\0" in layer.text else ():
            at = slice(m.start(), m.end(), 4 if m.group()[2] == "\0" else 2)
            yield Layer(layer.text[at], layer.start[at], layer.end[at])
        for mark, pattern, byte in (("%", _URL_PACKED, _URL_BYTE), ("\\x", _ESCAPE_PACKED, _LITERAL_BYTE)):
            for m in pattern.finditer(layer.text) if mark in layer.text else ():
                data, ends = _packed_bytes(m.group(), byte)
                if not is_packed(data):
                    continue
                size = packed_size(data)  # what follows the data on its line is not part of it
                yield self._content(data[:size], int(layer.start[m.start()]), int(layer.end[m.start() + ends[size - 1] - 1]))
        done: set[tuple[int, int]] = set()
        if "\n" in layer.text or "\\n" in layer.text:
            for m in _BASE64_LINES.finditer(layer.text):
                for a, b in _even_lines(layer.text, m.start(), m.end()):
                    done.add((a, b))
                    yield from self._aligned(layer, a, b)
        for pattern in (_BASE64, _BASE64_URL):
            for m in pattern.finditer(layer.text):
                if m.span() not in done:
                    done.add(m.span())
                    yield from self._aligned(layer, m.start(), m.end())

    def _aligned(self, layer: Layer, a: int, b: int) -> Iterator:
        """What a run of base64 letters holds.  Letters before the data can
        shift it, so the later alignments are tried if the first reads as
        nothing."""
        for shift in range(min(4, b - a - 15)):
            found = False
            for inner in self._base64(layer, a + shift, b):
                found = True
                yield inner
            if found:
                return

    def _base64(self, layer: Layer, a: int, b: int) -> Iterator:
        raw = layer.text[a:b]
        at = np.arange(a, b)
        if breaks := list(_BREAK.finditer(raw)):
            solid = np.ones(len(raw), bool)
            for m in breaks:
                solid[m.start() : m.end()] = False
            at = at[solid]
            raw = _BREAK.sub("", raw)
        body = raw.rstrip("=")
        if len(body) % 4 == 1:
            return
        try:
            data = base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))
        except (binascii.Error, ValueError):
            return
        if not data:
            return
        i = np.arange(len(data))
        first, last = at[i * 8 // 6], at[np.minimum((i * 8 + 7) // 6, len(body) - 1)]
        start, end = layer.start[first], layer.end[last]
        if is_packed(data):  # the padding belongs to it
            end[-1] = layer.end[at[-1]]
        yield from self._reading(data, start, end, False)

    def result(self) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base finds, all finds), each by start, then kind, then end."""
        return self.base, sorted(self.spans)


#: a text without any of these has no layer
_HIDES = re.compile(r"\0[\t\r\n -~]\0|%[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4}|\\[uUx]|&#|[A-Za-z0-9+/_-]{16}")


def _may_hide(text: str) -> bool:
    return _HIDES.search(text) is not None


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_oversize long"


def _scan(limit: int | None):
    def run(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(7)]
            for text in batch.column("text").to_pylist():
                scanner = Scanner(text or "", limit)
                base, spans = scanner.result()
                kinds = [k for _, k, _ in base]
                for col, value in zip(rows, (
                    kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(),
                    joined(spans), scanner.layers, scanner.oversize,
                ), strict=True):
                    col.append(value)
            kinds_ = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, t) for c, t in zip(rows, kinds_, strict=True)]],
                names=[c.split()[0] for c in _SCHEMA.split(", ")],
            )

    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int | None = MAX_LAYER) -> DataFrame:
    """Per row doc_id, counts and digest of the finds in the text as it is
    (n_assign, n_access, n_hex, base_sha256), all spans with those behind
    layers, n_layers and n_oversize (layers above ``limit``, scanned in blocks; with
    None every layer is read whole, however much memory that takes).

    Spans are code points of the text, end exclusive.  Null texts count as
    empty: no finds.  Null ids pass through, repeated rows are scanned each,
    an empty table gives no rows; further columns are not looked at.
    """
    return document_columns(docs, id_col, text_col).mapInArrow(_scan(limit), _SCHEMA)
