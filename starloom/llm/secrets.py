"""Secrets in texts and in the encoded layers inside them."""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from urllib.parse import unquote_to_bytes

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order, their patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
_HEX = re.compile(r"[0-9a-f]{32,}")  # the same matches: a run is taken whole, and shorter ones are dropped anyway

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_PERCENT_TOKEN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/-])+")
_ESCAPES = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_RUN = re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")
_URL_RUN = re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]+={0,2}")
# The end of a line of base64 and the start of the next: quotes, commas, signs that join texts, indents, marks of quoted mail.
_LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
_JOINT = re.compile(r"""(?P<line>[A-Za-z0-9+/_-]{16,})(?P<gap>["',;+\\\x20\t]*\r?\n[\x20\t>"']*)(?=[A-Za-z0-9+/_-])""")
_BYTES = re.compile(r"""(?:\\x[0-9A-Fa-f]{2})(?:\\x[0-9A-Fa-f]{2}|\\[nrtabfv0\\'"]|[^\\\x00-\x1f\x7f-\U0010ffff])*""")
_BYTE = re.compile(rb"""\\(?:x([0-9A-Fa-f]{2})|([nrtabfv0\\'"]))""")
_NAMED = dict(zip(b"nrtabfv0\\'\"", b"\n\r\t\a\b\f\v\0\\'\""))
_URL_SAFE = str.maketrans("-_", "+/")
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_SIGNS = re.compile(r"[+/]")
_WIDE = (b"\xff\xfe", b"\xfe\xff")  # marks of UTF-16
# Without any of these a text has no findings and no layers. What ACCESS, HEX and base64 need is a run of 16.
_ALIVE = re.compile(r"(?i:passw|secret|token|api_?key)|[A-Za-z0-9+/_-]{16}|%[0-9A-Fa-f]{2}|\\[uUx]|&#", re.ASCII)
CHUNK = 1 << 22  # an unpacked layer of more bytes is scanned in parts of about so many
STEP = 1 << 18  # bytes that are unpacked at a time, but for zstd
DEEPEST = 64  # compressed layers right inside each other, where each is too large to be compared with those above it
# Where a large layer is parted, nothing that is looked for can go on: behind a character that is in no pattern, a line end that
# ends no line of base64, or a blank between a word too short for a key and the next.
_PART = re.compile(
    r"""(?s:.*)(?:[^A-Za-z0-9+/_.=~%&#;\\{}"'\x20:\r\n-]|(?<=[^A-Za-z0-9+/;}\r])\n"""
    r"""|(?:(?<=\x20[a-z]{2})|(?<=\x20[a-z]{3})|(?<=\x20[a-z]{4}))\x20(?=[A-Za-z0-9]))"""
)


@dataclass
class Layer:
    """A text, and for every character of it where it came from in the document (None: the document itself).

    `whole` is the one place that all characters came from, if the layer was unpacked; `clear` says that its bytes were text.
    """

    text: str
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None
    above: frozenset[bytes] = field(default_factory=frozenset)
    whole: tuple[int, int] | None = None
    clear: bool = True

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.whole is not None:
            return self.whole
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def find(text: str) -> list[tuple[str, int, int]]:
    """The plain matches of a text as (kind, start, end), leftmost and non-overlapping within a kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _replaced(layer: Layer, edits: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
    """The layer with pieces put in place of others: (start, end, new text, where each new character came from)."""
    if layer.whole is not None:
        edges = [0, *[x for start, end, *_ in edits for x in (start, end)], len(layer.text)]
        kept = [layer.text[a:b] for a, b in zip(edges[::2], edges[1::2])]
        text_ = "".join(x for pair in zip(kept, [*[new for _, _, new, _ in edits], ""]) for x in pair)
        return Layer(text_, above=layer.above, whole=layer.whole, clear=layer.clear)
    at, text, starts, ends = 0, [], [], []

    def keep(upto: int) -> None:
        text.append(layer.text[at:upto])
        starts.append(np.arange(at, upto) if layer.starts is None else layer.starts[at:upto])
        ends.append(np.arange(at + 1, upto + 1) if layer.ends is None else layer.ends[at:upto])

    for start, end, new, places in edits:
        keep(start)
        text.append(new)
        spans = [layer.span(a, b) for a, b in places]
        starts.append(np.array([a for a, _ in spans], dtype=np.int64))
        ends.append(np.array([b for _, b in spans], dtype=np.int64))
        at = end
    keep(len(layer.text))
    return Layer("".join(text), np.concatenate(starts), np.concatenate(ends), layer.above, clear=layer.clear)


def _byte_places(text: str) -> list[tuple[int, int]]:
    """First and last byte of each character."""
    at, places = 0, []
    for c in text:
        n = len(c.encode("utf-8"))
        places.append((at, at + n))
        at += n
    return places


def _packed(data: bytes) -> bool:
    """Whether bytes start like gzip, zlib, bz2, xz or zstd."""
    zlib_ = data[:1] == b"\x78" and len(data) > 1 and (data[0] * 256 + data[1]) % 31 == 0
    return zlib_ or data.startswith((b"\x1f\x8b", b"BZh", b"\xfd7zXZ", b"\x28\xb5\x2f\xfd"))


class Member:
    """Unpacks one member or frame; `rest` is what stands behind its end."""

    def __init__(self, data: bytes) -> None:
        self.ended, self.rest = False, b""
        self.loose = data[:1] == b"\x78"  # words may start so, too
        if data[:2] == b"\x1f\x8b":
            self.tool = zlib.decompressobj(31)
        elif data[:3] == b"BZh":
            self.tool = bz2.BZ2Decompressor()
        elif data[:5] == b"\xfd7zXZ":
            self.tool = lzma.LZMADecompressor()
        elif self.loose:
            self.tool = zlib.decompressobj()
        else:
            import zstandard

            self.tool = zstandard.ZstdDecompressor().decompressobj()

    def feed(self, data: bytes) -> Iterator[bytes]:
        """What comes out for the next bytes, in steps. ValueError if they are broken."""
        try:
            if type(self.tool).__module__.startswith("zstandard"):  # has no limit, but a block of a few bytes is 128 KB at most
                for at in range(0, len(data), 64):
                    yield self.tool.decompress(data[at : at + 64])
                    if self.tool.eof:
                        self.ended, self.rest = True, self.tool.unused_data + data[at + 64 :]
                        return
                return
            while True:
                out = self.tool.decompress(data, STEP)
                yield out
                if self.tool.eof:
                    self.ended, self.rest = True, self.tool.unused_data
                    return
                data = getattr(self.tool, "unconsumed_tail", b"")
                if not data and getattr(self.tool, "needs_input", len(out) < STEP):
                    return
        except (zlib.error, OSError, lzma.LZMAError, EOFError) as error:
            raise ValueError from error
        except Exception as error:  # zstandard raises a type of its own, which is loaded only where it is needed
            if type(error).__module__.split(".")[0] == "zstandard":
                raise ValueError from error
            raise


class Unpacking:
    """What a stream of bytes unpacks to, member after member. `rest` is what is left: all of it if nothing came out."""

    def __init__(self, source: Iterator[bytes]) -> None:
        self.source, self.rest = source, iter(())
        self.some = self.broken = False

    def __iter__(self) -> Iterator[bytes]:
        data, held, member = b"", [], None
        while True:
            while member is None and len(data) < 8 and (more := next(self.source, None)) is not None:
                data = (data + more).lstrip(b"\0") if self.some else data + more  # members may be padded
            if member is None:
                skipped = data[1:4] == b"\x2a\x4d\x18" and data[0] >> 4 == 5  # a frame of zstd that holds no data
                if not _packed(data) and not (self.some and skipped):
                    self.rest = chain(held, [data] if data else [], self.source)
                    return
                member = Member(data)
            if not self.some:
                held.append(data)
            try:
                for out in member.feed(data):
                    if out:
                        self.some = True
                        held = []
                        yield out
            except ValueError:
                self.broken = self.some and not member.loose
                self.rest = chain([data] if self.some else held, self.source)
                return
            if member.ended:
                data, member = member.rest.lstrip(b"\0"), None
                held = []
            elif (more := next(self.source, None)) is not None:
                data = more
            else:
                self.broken = self.some and not member.loose
                self.rest = iter(held)
                return


def _sliced(data: bytes) -> Iterator[bytes]:
    return (data[at : at + STEP] for at in range(0, len(data), STEP))


def _start(source: Iterator[bytes], least: int) -> bytes:
    """The next bytes of a stream, at least so many if there are."""
    parts, n = [], 0
    while n < least and (part := next(source, None)) is not None:
        parts.append(part)
        n += len(part)
    return b"".join(parts)


def _parts(texts: Iterator[str]) -> Iterator[str]:
    """A text that comes in pieces, in parts of about CHUNK that nothing crosses; longer ones only where it has no break."""
    held, limit = "", CHUNK
    for text in texts:
        held += text
        if len(held) >= limit:
            m = _PART.match(held)
            if m is None:
                limit = 2 * len(held)
                continue
            yield held[: m.end()]
            held, limit = held[m.end() :], CHUNK + len(held) - m.end()
    if held:
        yield held


Text = tuple[str, bool, list[tuple[int, int]] | None]


def _unmarked(data: bytes) -> str | None:
    """The byte order of UTF-16 without a mark, if nearly every other byte is NUL."""
    half = len(data) // 2
    if half < 4 or b"\0" not in data:
        return None
    for order, high in (("utf-16-le", data[1::2]), ("utf-16-be", data[::2])):
        if high.count(0) >= 0.9 * half and data.count(0) <= 1.1 * half:
            return order
    return None


def _read_wide(data: bytes, order: str, exact: bool) -> Iterator[Text]:
    """The text of UTF-16 without a mark; a last odd byte is left out."""
    text = data[: len(data) // 2 * 2].decode(order, "replace")
    narrow = exact and all(c < "\U00010000" for c in text)
    yield text, not _CONTROL.search(text), [(2 * i, 2 * i + 2) for i in range(len(text))] if narrow else None


def _inflating(data: bytes) -> Iterator[bytes]:
    """What raw deflate, which has no mark of its own, unpacks to, in steps. ValueError if it does not end where the data does."""
    tool = zlib.decompressobj(-15)
    while not tool.eof:
        try:
            out = tool.decompress(data, STEP)
        except zlib.error as error:
            raise ValueError from error
        data = tool.unconsumed_tail
        if not (tool.eof or data or len(out) == STEP):
            raise ValueError
        yield out
    if len(tool.unused_data) > 2:
        raise ValueError


def _inflated(data: bytes) -> int:
    """How many bytes raw deflate unpacks to, of which none is kept; 0 if the data is something else."""
    try:
        return sum(map(len, _inflating(data)))
    except ValueError:
        return 0


def _read(data: bytes, exact: bool) -> Iterator[Text]:
    if (order := _unmarked(data)) is not None:
        yield from _read_wide(data, order, exact)
    wide = data[:2] in _WIDE
    text = data.decode("utf-16" if wide else "utf-8", "replace")
    clear = bool(text) and not _CONTROL.search(text)
    if clear and "\ufffd" in text:  # which may also be a character of the text
        try:
            data.decode("utf-16" if wide else "utf-8")
        except UnicodeDecodeError:
            clear = False
    if clear or wide:
        yield text, clear, _byte_places(text) if exact and not wide else None
    if not clear or wide:
        text = data.decode("latin-1")
        if _ALIVE.search(text):
            yield text, False, [(i, i + 1) for i in range(len(text))] if exact else None


def _read_parts(source: Iterator[bytes]) -> Iterator[Text]:
    """The texts of bytes that may be many."""
    head = _start(source, CHUNK)
    if len(head) < CHUNK:
        yield from _read(head, False)
        return
    wide = codecs.getincrementaldecoder("utf-16")("replace") if head[:2] in _WIDE else None
    texts: list[str] = []  # what the wide reading has, next to the plain one

    def plain() -> Iterator[str]:
        for part in chain([head], source):
            if wide:
                texts.append(wide.decode(part))
            yield part.decode("latin-1")

    held = ""
    for part in _parts(plain()):
        for text, clear, _ in _read(part.encode("latin-1"), False) if not wide else [(part, False, None)]:
            yield text, clear, None
        if wide:
            *done, held = _parts(iter([held, *texts]))
            texts.clear()
            yield from ((x, not _CONTROL.search(x), None) for x in done)
    if held:
        yield held, not _CONTROL.search(held), None


class Opened:
    """Counts compressed layers that break off."""

    def __init__(self) -> None:
        self.unopened = 0

    def texts_of(self, data: bytes) -> Iterator[Text]:
        """What bytes can be read as: a text, whether it is clear, and the bytes of each character (None: those of all).

        Compressed layers are opened until none is left, all members of each. What is large is never held whole: it is unpacked
        and read in parts. Bytes that are no clear text are read as Latin-1: all patterns are of ASCII, and so match the same
        there, whatever bytes stand beside them.
        """
        if not _packed(data):
            return self._read_or_inflate(data)
        return self._open(_sliced(data), frozenset([hashlib.sha256(data).digest()]), 0, data)

    def _read_or_inflate(self, data: bytes) -> Iterator[Text]:
        """Bytes without the mark of a packer: as text, and where they are none as raw deflate."""
        clear = False
        for text in _read(data, True):
            clear |= text[1]
            yield text
        size = 0 if clear else _inflated(data)
        if size >= CHUNK:  # so much is no accident, and is read like what has a mark
            yield from self._open(_inflating(data), frozenset([hashlib.sha256(data).digest()]), 1)
        elif size >= 8:
            out = b"".join(_inflating(data))
            if _packed(out):
                yield from self._open(_sliced(out), frozenset([hashlib.sha256(out).digest()]), 1)
            else:
                yield from ((text, clear, None) for text, clear, _ in _read(out, False) if clear)

    def _open(self, source: Iterator[bytes], above: frozenset[bytes], depth: int, data: bytes | None = None) -> Iterator[Text]:
        head = _start(source, 8)
        source = chain([head], source)
        if not _packed(head) or depth == DEEPEST:
            self.unopened += _packed(head)
            yield from _read_parts(source)
            return
        level = Unpacking(source)
        inner = iter(level)
        first = _start(inner, CHUNK)
        if len(first) >= CHUNK:
            yield from self._open(chain([first], inner), above, depth + 1)
        elif first and (mark := hashlib.sha256(first).digest()) not in above:  # else it unpacks to itself
            yield from self._open(iter([first]), above | {mark}, depth)
        self.unopened += level.broken
        if data is not None and not level.some:
            yield from _read(data, True)
        elif rest := _start(level.rest, 1):
            yield from _read_parts(chain([rest], level.rest))


def _percent(layer: Layer, opened: Opened) -> Iterator[Layer]:
    if "%" not in layer.text:
        return
    for m in _PERCENT_TOKEN.finditer(layer.text):
        if "%" in m[0] and _packed(data := unquote_to_bytes(m[0])):
            for text, clear, of_bytes in opened.texts_of(data):
                if of_bytes is None:
                    yield Layer(text, above=layer.above, whole=layer.span(*m.span()), clear=clear)
    edits = []
    for m in _PERCENT.finditer(layer.text):
        data = bytes.fromhex(m[0].replace("%", ""))
        try:
            new = data.decode("utf-8")
            places = _byte_places(new)
        except UnicodeDecodeError:
            new = data.decode("latin-1")
            places = [(i, i + 1) for i in range(len(new))]
        edits.append((*m.span(), new, [(m.start() + 3 * a, m.start() + 3 * b) for a, b in places]))
    if edits:
        yield _replaced(layer, edits)


def _escaped(m: re.Match) -> bytes:
    return bytes([int(m[1], 16) if m[1] else _NAMED[m[2][0]]])


def _escapes(layer: Layer, opened: Opened) -> Iterator[Layer]:
    if "\\" not in layer.text and "&#" not in layer.text:
        return
    for m in _BYTES.finditer(layer.text):
        if _packed(data := _BYTE.sub(_escaped, m[0].encode("latin-1"))):
            for text, clear, of_bytes in opened.texts_of(data):
                if of_bytes is None:
                    yield Layer(text, above=layer.above, whole=layer.span(*m.span()), clear=clear)
    edits: list[tuple[int, int, str, list[tuple[int, int]]]] = []
    high: tuple[int, int, int] | None = None  # the first half of a pair: start, end, code
    for m in _ESCAPES.finditer(layer.text):
        code = int(m[6]) if m[6] else int(m[1] or m[2] or m[3] or m[4] or m[5], 16)
        start, end = m.span()
        if high and high[1] == start and 0xDC00 <= code < 0xE000:
            start, code = high[0], 0x10000 + ((high[2] - 0xD800) << 10) + (code - 0xDC00)
        high = (start, end, code) if 0xD800 <= code < 0xDC00 else None
        if code <= 0x10FFFF and not 0xD800 <= code < 0xE000:
            edits.append((start, end, chr(code), [(start, end)]))
    if edits:
        yield _replaced(layer, edits)


def _bytes(letters: str) -> bytes:
    return binascii.a2b_base64(letters + "=" * (-len(letters) % 4))


def _decoded(layer: Layer, start: int, run: str, places: np.ndarray | None, opened: Opened) -> Iterator[Layer]:
    """What a run of base64 letters holds at each of the four alignments."""
    letters = run.rstrip("=")
    at = (lambda i: start + i) if places is None else (lambda i: int(places[i]))
    for shift in range(4):
        body = letters[shift:]
        body = body[: len(body) - (len(body) % 4 == 1)]
        if len(body) < 11:
            return
        for text, clear, of_bytes in opened.texts_of(_bytes(body)):
            if of_bytes is None:
                whole = layer.span(at(shift), at(shift + len(body) - 1) + 1)
                yield Layer(text, above=layer.above, whole=whole, clear=clear)
                continue
            edges = np.array(of_bytes, dtype=np.int64).reshape(-1, 2)
            first = shift + edges[:, 0] // 3 * 4
            last = np.minimum(shift + (edges[:, 1] - 1) // 3 * 4 + 3, shift + len(body) - 1)
            first, last = (start + first, start + last) if places is None else (places[first], places[last])
            if layer.whole is not None:
                yield Layer(text, above=layer.above, whole=layer.whole, clear=clear)
                continue
            if layer.starts is not None:
                spans = [layer.span(a, b + 1) for a, b in zip(first.tolist(), last.tolist())]
                first, last = (np.array([x[k] for x in spans], dtype=np.int64) - k for k in (0, 1))
            yield Layer(text, first, last + 1, layer.above, clear=clear)


def _pieces(layer: Layer, start: int, run: str, places: np.ndarray | None, opened: Opened) -> Iterator[Layer]:
    """The layers of a run, and of its pieces between the signs that paths and names have too.

    In example.com/files/... the payload starts behind a sign. If no reading of the whole run is clear text, the parts between
    signs are read on their own. Compressed data must be read from its first byte on, and may hold signs itself: what starts
    like such data behind a sign is read to the end of the run.
    """
    clear = False
    for child in _decoded(layer, start, run, places, opened):
        clear |= child.clear
        yield child
    signs = [m.end() for m in _SIGNS.finditer(run)]
    for a, b in zip([0, *signs], [*[x - 1 for x in signs], len(run)]):
        here = None if places is None else places[a:]
        if a and len(run) >= a + 16 and _packed(_bytes(run[a : a + 8])):
            yield from _decoded(layer, start + a, run[a:], here, opened)
        if signs and not clear and b - a >= 16:
            yield from _decoded(layer, start + a, run[a:b], here, opened)


def _lines(text: str) -> Iterator[np.ndarray]:
    """Places of the letters of base64 that goes over lines of any one width, in either alphabet, indented, quoted or not. The first line
    may stand behind other text, and the last one, which may be shorter, in front of some."""
    at = 0
    while (m := _JOINT.search(text, at)) is not None:
        width, parts = len(m["line"]), [np.arange(m.start(), m.end("line"))]
        at = m.end()
        while (run := _LETTERS.match(text, at)) is not None and len(run[0]) <= width:
            end = run.end()
            if len(run[0]) < width:
                while end < len(text) and text[end] == "=" and end < run.end() + 2:
                    end += 1
            parts.append(np.arange(at, end))
            joint = _JOINT.match(text, at) if len(run[0]) == width else None
            at = end if joint is None else joint.end()
            if joint is None:
                break
        if len(parts) > 1:
            yield np.concatenate(parts)


def _base64(layer: Layer, opened: Opened) -> Iterator[Layer]:
    read: list[tuple[int, int]] = []  # lines that were text or data together are not read one by one
    if "\n" in layer.text:
        for places in _lines(layer.text):
            run = "".join(map(layer.text.__getitem__, places.tolist())).translate(_URL_SAFE)
            clear = False
            for child in _pieces(layer, int(places[0]), run, places, opened):
                clear |= child.clear
                yield child
            if clear:
                read.append((int(places[0]), int(places[-1])))
    runs: list[tuple[int, str, np.ndarray | None]] = []
    for m in _WRAPPED.finditer(layer.text):
        places = np.array([m.start() + i for i, c in enumerate(m[0]) if c not in "\r\n"])
        runs.append((m.start(), m[0].replace("\r", "").replace("\n", ""), places))
    runs += [(m.start(), m[0], None) for m in _RUN.finditer(layer.text)]
    if "-" in layer.text or "_" in layer.text:
        for m in _URL_RUN.finditer(layer.text):
            if "-" in m[0] or "_" in m[0]:
                runs.append((m.start(), m[0].translate(_URL_SAFE), None))
    for start, run, places in runs:
        k = bisect_right(read, (start, len(layer.text))) - 1
        if k < 0 or start > read[k][1]:
            yield from _pieces(layer, start, run, places, opened)


def unwrap(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int, int]:
    """All findings of a text: the plain ones, all of them with those in layers, the layers opened, and those not opened.

    A list of layers to do starts with the text. Each layer is scanned, its findings are carried back to the document, and
    its percent escapes, Unicode escapes and base64 runs (compressed or not) give new layers, until none is new. Parts of a large layer count each. A layer
    whose content was met above itself ends there, as does one met before at the same place. Bytes that are no clear text are
    scanned too, but count as a layer only if something is found in them: most are words taken for base64.
    """
    plain = find(text)
    everything = set(plain)
    opened = Opened()
    todo = [iter([Layer(text)])]  # the next layers of each layer on the way down; large ones are made when their turn comes
    met: set[tuple[bytes, int, int]] = set()
    layers = 0
    while todo:
        if (layer := next(todo[-1], None)) is None:
            todo.pop()
            continue
        mark = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        place = (mark, *layer.span(0, len(layer.text))) if layer.text else None
        if place is None or mark in layer.above or place in met:
            continue
        met.add(place)
        if layer.above:
            found = find(layer.text)
            layers += layer.clear or bool(found)
            everything.update((kind, *layer.span(a, b)) for kind, a, b in found)
        layer.above = layer.above | {mark}
        todo.append(chain(_percent(layer, opened), _escapes(layer, opened), _base64(layer, opened)))
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    return sorted(plain, key=order), sorted(everything, key=order), layers, opened.unopened


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SCHEMA = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_layers bigint, n_unopened bigint"


def scan(docs: DataFrame) -> DataFrame:
    """Add what `unwrap` finds to documents, one row each; their own columns stay.

    Counts and base_sha256 are of the plain findings, spans of all (kind:start:end in code points, end exclusive, by start,
    then kind). Null and empty texts have no findings; repeated rows are scanned each. Added
    columns take the place of ones that are named like them.
    """

    @F.pandas_udf(f"struct<{', '.join(c.replace(' ', ':') for c in _SCHEMA.split(', '))}>")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            plain, everything, layers, unopened = unwrap(text or "")
            counts = [sum(k == kind for k, _, _ in plain) for kind in KINDS]
            rows.append((*counts, hashlib.sha256(_joined(plain).encode()).hexdigest(), _joined(everything), layers, unopened))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    found = docs.withColumn("__found", scanned("text"))
    added = {c.split()[0] for c in _SCHEMA.split(", ")}
    return found.select(*[f"`{c}`" for c in docs.columns if c not in added], "__found.*")


def op2(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).drop("text")
