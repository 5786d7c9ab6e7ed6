"""Secret scans: nested encodings are unwrapped by a worklist and every layer is scanned.

The text is the first layer. The text with all its URL escapes decoded, the text with all its
Unicode escapes decoded, and each run that decodes as base64 (plain or of a compressed stream;
on one line or wrapped) become further layers, as do compressed streams whose bytes stand in the text, escaped or not,
and so on until no layer yields a new one. Bytes that are not UTF-8 are read as Latin-1, with
zero bytes also as UTF-16. Layers with a content already seen are not taken up again, which ends cycles. Each
layer knows which characters of the original text each of its characters came from, so a
match in any layer maps back to a span of the original: exact for URL, Unicode and base64
layers, the whole encoded run for compressed ones.

Defined results: a null or empty text has no spans; a span found again in a deeper layer at the
same place and of the same kind counts once; repeated rows get equal results; extra columns
pass through ``mask_secrets`` untouched. Streams are unpacked as long as what they hold is a
stream again, all members of each. One that unpacks to more than ``MOST_UNPACKED`` bytes is scanned
in overlapping pieces; an encoded run in it that is longer than the overlap and crosses a piece's
border is decoded in parts only.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import itertools
import lzma
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pulsemill.llm.frames import struct_array, text_column
from pulsemill.llm.text import raw_bytes

# The content held at once; longer streams are scanned in pieces that share 1/OVERLAP of their length.
MOST_UNPACKED = 8 << 20
OVERLAP = 8
# How many streams directly inside one another are followed above that size, which ends streams that hold a larger copy
# of themselves. Below it there is no such limit.
MOST_NESTED = 16
_STEP, _CHUNK, _HEAD = 1 << 20, 1 << 10, 64

# The kinds in their order, and the patterns of the base scan.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_ASSIGN_LENGTH, _ACCESS_LENGTH, _HEX_LENGTH = 6, 20, 24
# Runs of hexadecimal digits that are too short never match, so they need not be tried one by one.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")

_URL_UNIT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE_UNIT = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#(?:\d{1,7}|[xX][0-9A-Fa-f]{1,6});")
_BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_PART = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")
_SHORTEST_BASE64 = 16
# Neighbouring lines of base64 letters and nothing else, also with line ends written as \\n; the first may start in a line.
_WRAPPED = re.compile(
    r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nrt])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{16,}+"
    r"(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*(?!--)[A-Za-z0-9+/_-]++(?![ \t]*[^\s\\\"'<>),;=]))+"
)
_WRAPPED_LINE = re.compile(r"(?:(?<=\\n)|(?<![A-Za-z0-9+/_\\-]))[A-Za-z0-9+/_-]+")
# What a span or a further layer needs at least.
_SIGN = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|[A-Za-z0-9+/_-]{16}|%[0-9A-Fa-f]{2}|\\[xu0-7abfnrtv]|&#"
    rb"|\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd"
)
# How gzip, zlib, bzip2, xz and zstandard members begin; the same as characters of one byte each.
_STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.DOTALL)
_STREAM_TEXT = re.compile("\x1f\x8b\x08|x[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\\x28\xb5/\xfd")
_NO_BYTE = re.compile("[^\x00-\xff]")
_BYTE_UNIT = re.compile(r"""\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}|\\[0-7]{1,3}|\\[abfnrtv\\'"/]|&#(?:\d{1,3}|[xX][0-9A-Fa-f]{1,2});""")
_C_ESCAPES = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


@dataclass(frozen=True)
class Layer:
    """Decoded text; for each character where its source starts and ends in the original, and whether it was decoded."""

    text: str
    starts: np.ndarray
    ends: np.ndarray
    decoded: np.ndarray


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns in a text, leftmost and without overlaps within a kind."""
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LENGTH]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return spans


@dataclass(frozen=True)
class Content:
    """Bytes that are yet to be unpacked or read as text; for each where its source starts and ends in the original."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray


class _Member:
    """One gzip, zlib, bzip2, xz or zstandard member: gives its content in steps, then says what it left over."""

    def __init__(self, head: bytes) -> None:
        self.zlib = self.zstd = self.ended = False
        self.left = b""
        if head[:3] == b"\x1f\x8b\x08":
            self.zlib, self.inner = True, zlib.decompressobj(31)
        elif head[:3] == b"BZh":
            self.inner = bz2.BZ2Decompressor()
        elif head[:6] == b"\xfd7zXZ\x00":
            self.inner = lzma.LZMADecompressor()
        elif head[:4] == b"\x28\xb5\x2f\xfd":
            self.zstd, self.inner = True, zstandard.ZstdDecompressor().decompressobj()
        else:
            self.zlib, self.inner = True, zlib.decompressobj(15)

    def feed(self, data: bytes) -> Iterator[bytes]:
        inner = self.inner
        # A step of zstandard has no limit of its own, so its input goes in small steps.
        for i in range(0, len(data), 256) if self.zstd else [0]:
            part = data[i : i + 256] if self.zstd else data
            while True:
                out = inner.decompress(part) if self.zstd else inner.decompress(part, _STEP)
                if out:
                    yield out
                if inner.eof:
                    self.ended, self.left = True, inner.unused_data + (data[i + 256 :] if self.zstd else b"")
                    return
                part = inner.unconsumed_tail if self.zlib else b""
                if self.zstd or (not part and (len(out) < _STEP if self.zlib else inner.needs_input)):
                    break


def _is_stream(head: bytes) -> bool:
    return _STREAM.match(head) is not None


def _begins(head: bytes) -> bool:
    """Whether bytes that begin like a stream can go on as one, by its fixed header fields and the head of the first
    block. False heads, of which a text may hold very many, are turned away without setting up a decompressor."""
    if head[:1] == b"x":
        block = head[2:7]
    elif head[:3] == b"\x1f\x8b\x08":
        if len(head) > 3 and head[3] & 0xE0:
            return False
        block = head[10:15] if len(head) > 3 and not head[3] else b""
    elif head[:3] == b"BZh":
        return head[4:10] in (b"1AY&SY"[: len(head[4:10])], b"\x17rE8P\x90"[: len(head[4:10])])
    else:
        return True
    if not block:
        return True
    kind = block[0] >> 1 & 3
    # Kind 3 is none; a stored block has its length and the complement of it.
    return kind != 3 and (kind != 0 or len(block) < 5 or block[1] ^ block[3] == block[2] ^ block[4] == 0xFF)


class _Unpacked:
    """The content of a stream that comes in chunks, all its members joined. Bytes that are no member come as they are
    if ``rest`` is set. ``used`` counts the bytes of the members."""

    def __init__(self, chunks: Iterable[bytes], rest: bool) -> None:
        self.chunks, self.rest, self.used = iter(chunks), rest, 0

    def __iter__(self) -> Iterator[bytes]:
        data = b""
        while True:
            while len(data) < 6 and (more := next(self.chunks, None)) is not None:
                data += more
            if not _is_stream(data) or not _begins(data[:16]):
                break
            member = _Member(data)
            try:
                while data:
                    yield from member.feed(data)
                    self.used += len(data) - len(member.left)
                    data = member.left if member.ended else next(self.chunks, b"")
                    if member.ended:
                        break
            except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError):
                break
        if self.rest:
            if data:
                yield data
            yield from self.chunks


def _chunks(data: bytes) -> Iterator[bytes]:
    return (data[i : i + _CHUNK] for i in range(0, len(data), _CHUNK))


def _overlapping(parts: Iterable[bytes], limit: int) -> Iterator[bytes]:
    """A long stream in pieces of at most ``limit`` bytes, each with the end of the one before."""
    held = bytearray()
    for part in parts:
        held += part
        while len(held) > limit:
            yield bytes(held[:limit])
            del held[: limit - limit // OVERLAP]
    yield bytes(held)


def _unpack(unpacked: _Unpacked, limit: int) -> tuple[bytes, Iterator[bytes] | None]:
    """The content of a stream if it is at most ``limit`` bytes long, or its beginning and pieces of the whole."""
    parts, first = iter(unpacked), bytearray()
    for part in parts:
        first += part
        if len(first) > limit:
            break
    else:
        return bytes(first), None
    content: Iterator[bytes] = itertools.chain([bytes(first)], parts)
    head = bytes(first[:_HEAD])
    for _ in range(MOST_NESTED):
        if not _is_stream(head):
            break
        # What is no stream after all, or unpacks to itself, begins with the same bytes again.
        content, before = iter(_Unpacked(content, True)), head
        start = bytearray()
        for part in content:
            start += part
            if len(start) >= _HEAD:
                break
        head, content = bytes(start[:_HEAD]), itertools.chain([bytes(start)], content)
        if head == before:
            break
    return bytes(first), _overlapping(content, limit)


def _readable(data: bytes) -> str | None:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if not c.isprintable() and c not in "\t\n\r")
    return text if text and odd * 20 <= len(text) else None


def _bytes_per_char(text: str) -> np.ndarray:
    return np.array([len(c.encode("utf-8", "surrogatepass")) for c in text], np.int64)


def _by_units(layer: Layer, a: int, z: int, unit: re.Pattern, decode) -> Layer | None:
    """Decode the escapes between two places; characters between them stay as they are."""
    text, pieces, starts, ends, decoded, at = layer.text[a:z], [], [], [], [], 0

    def plain(i: int, j: int) -> None:
        pieces.append(text[i:j])
        starts.append(layer.starts[a + i : a + j])
        ends.append(layer.ends[a + i : a + j])
        decoded.append(layer.decoded[a + i : a + j])

    for m in unit.finditer(text):
        got = decode(m[0])
        if got is None:
            continue
        plain(at, m.start())
        chars, widths = got
        steps = np.concatenate([[0], np.cumsum(widths)])
        pieces.append(chars)
        starts.append(layer.starts[a + m.start() + steps[:-1]])
        ends.append(layer.ends[a + m.start() + steps[1:] - 1])
        decoded.append(np.ones(len(chars), bool))
        at = m.end()
    if not at:
        return None
    plain(at, len(text))
    return Layer("".join(pieces), np.concatenate(starts), np.concatenate(ends), np.concatenate(decoded))


def _decode_url(unit: str) -> tuple[str, np.ndarray] | None:
    text = bytes.fromhex(unit.replace("%", "")).decode("utf-8", "replace")
    widths = _bytes_per_char(text) * 3
    if widths.sum() != len(unit):
        # Bytes that are not UTF-8 stand for themselves.
        text = bytes.fromhex(unit.replace("%", "")).decode("latin-1")
        widths = np.full(len(text), 3)
    return text, widths


def _decode_escape(unit: str) -> tuple[str, np.ndarray] | None:
    if unit.startswith("&"):
        text = html.unescape(unit)
        return (text, np.array([len(unit)])) if len(text) == 1 else None
    if unit.startswith("\\u") and "{" not in unit:
        raw = b"".join(int(x, 16).to_bytes(2, "big") for x in unit.split("\\u")[1:])
        text = raw.decode("utf-16-be", "replace")
        widths = np.array([12 if ord(c) > 0xFFFF else 6 for c in text])
        return (text, widths) if widths.sum() == len(unit) else None
    code = int(unit.strip("\\ux{}"), 16)
    return (chr(code), np.array([len(unit)])) if code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else None


def _worth(data: bytes) -> bool:
    """Whether bytes can give a span or a further layer, read as text of one or two bytes a character."""
    return _SIGN.search(data) is not None or (b"\0" in data and _SIGN.search(data.replace(b"\0", b"")) is not None)


def _decode_base64(layer: Layer, lines: Sequence[tuple[int, int]]) -> Content | None:
    run = "".join(layer.text[a:z] for a, z in lines).rstrip("=")
    if len(run) % 4 == 1:
        run = run[:-1]
    try:
        data = base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    if not _worth(data):
        return None
    places = np.concatenate([np.arange(a, z) for a, z in lines])
    # Byte i of the content lies in the characters from 8i/6 on to (8i + 7)/6.
    bits = np.arange(len(data)) * 8
    return Content(data, layer.starts[places[bits // 6]], layer.ends[places[np.minimum((bits + 7) // 6, len(run) - 1)]])


def _whole(data: bytes, limit: int) -> bool:
    """Whether content is readable text, or streams from end to end: decoded as it was meant."""
    if not _is_stream(data):
        return _readable(data) is not None
    unpacked = _Unpacked(_chunks(data), False)
    return _unpack(unpacked, limit)[1] is not None or unpacked.used == len(data)


def _as_texts(content: Content) -> list[Layer]:
    """The content as UTF-8, or else as Latin-1; with zero bytes also as UTF-16 of either order, from either byte on."""
    data = content.data
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
    n = len(text)
    if n == len(data):
        out = [Layer(text, content.starts, content.ends, np.ones(n, bool))]
    else:
        steps = np.concatenate([[0], np.cumsum(_bytes_per_char(text))])
        out = [Layer(text, content.starts[steps[:-1]], content.ends[steps[1:] - 1], np.ones(n, bool))]
    if b"\0" in data and _worth(data):
        for first in (0, 1):
            n = (len(data) - first) // 2
            for order in ("<u2", ">u2"):
                units = np.frombuffer(data, order, n, first)
                # One character a unit, whatever the unit; the patterns are ASCII.
                text = units.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                starts, ends = content.starts[first : first + 2 * n : 2], content.ends[first + 1 : first + 2 * n : 2]
                out.append(Layer(text, starts, ends, np.ones(n, bool)))
    return [x for x in out if x.text]


def _wrapped_runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Base64 over neighbouring lines: all of them, all but the first, and those of one width with the shorter one after."""
    for m in _WRAPPED.finditer(text):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in _WRAPPED_LINE.finditer(m[0])]
        widths = [z - a for a, z in lines]
        groups, i = [(0, len(lines)), (1, len(lines))], 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and widths[j] == widths[i]:
                j += 1
            after = j < len(lines) and widths[j] < widths[i]
            groups.append((i, j + after))
            i = j
        for i, j in dict.fromkeys(groups):
            if j - i > 1:
                yield lines[i:j]


def _latin_url(unit: str) -> str:
    return bytes.fromhex(unit.replace("%", "")).decode("latin-1")


def _latin_escape(unit: str) -> str:
    if unit.startswith("&"):
        code = int(unit[3:-1], 16) if unit[2] in "xX" else int(unit[2:-1])
        return chr(code)
    if unit[1] in "xu":
        return chr(int(unit[2:], 16))
    return chr(int(unit[1:], 8) & 255) if unit[1] in "01234567" else _C_ESCAPES.get(unit[1], unit[1])


def _byte_streams(layer: Layer, limit: int) -> Iterator[tuple[int, Layer, bytes, Iterator[bytes] | None, _Unpacked]]:
    """Compressed streams that stand in a text as bytes, escaped or not: place, the text unescaped, content, pieces if long."""
    forms = [layer]
    for unit, latin, width in ((_URL_UNIT, _latin_url, 3), (_BYTE_UNIT, _latin_escape, 0)):
        if unit.search(layer.text) and _STREAM_TEXT.search(unit.sub(lambda m, f=latin: f(m[0]), layer.text)):

            def decode(x: str, f=latin, width=width) -> tuple[str, np.ndarray]:
                text = f(x)
                return text, np.full(len(text), width or len(x))

            forms.append(_by_units(layer, 0, len(layer.text), unit, decode))
    for form in forms:
        at = z = 0
        while m := _STREAM_TEXT.search(form.text, at):
            a = m.start()
            if not _begins(form.text[a : a + 16].encode("latin-1", "replace")):
                at = a + 1
                continue
            if a >= z:  # where the run of one-byte characters ends that the head stands in
                last = _NO_BYTE.search(form.text, a)
                z = last.start() if last else len(form.text)
            chunks = (form.text[i : min(i + _CHUNK, z)].encode("latin-1") for i in range(a, z, _CHUNK))
            unpacked = _Unpacked(chunks, False)
            first, pieces = _unpack(unpacked, limit)
            if first:
                # How far a long stream goes is known when its pieces have been read.
                yield a, form, first, pieces, unpacked
            at = a + max(unpacked.used, 1)


def _next_layers(layer: Layer, limit: int) -> list[Layer | Content]:
    found: list[Layer | Content | None] = []
    for unit, decode in ((_URL_UNIT, _decode_url), (_ESCAPE_UNIT, _decode_escape)):
        if unit.search(layer.text):
            # All units at once: a key may be encoded where its value, behind blanks or quotes, is not.
            found.append(_by_units(layer, 0, len(layer.text), unit, decode))
    covered = np.zeros(len(layer.text), bool)
    for lines in _wrapped_runs(layer.text) if "\n" in layer.text or "\\n" in layer.text else ():
        content = _decode_base64(layer, lines)
        found.append(content)
        if content is not None and _whole(content.data, limit):
            for a, z in lines:
                covered[a:z] = True
    for m in _BASE64_RUN.finditer(layer.text):
        if covered[m.start() : m.end()].any() and covered[m.start() : m.start() + len(m[0].rstrip("="))].all():
            continue
        # A path or a name may stand before the encoded part, joined by a letter of the alphabet.
        parts = [(m.start() + p.start(), m.start() + p.end()) for p in _BASE64_PART.finditer(m[0])]
        for a, z in dict.fromkeys([m.span(), *parts]):
            content = _decode_base64(layer, [(a, z)])
            found.append(content)
            if content is not None and (a, z) == m.span() and _whole(content.data, limit):
                break
    return [x for x in found if x is not None]


def _coarse(data: bytes, start: int, end: int) -> Content:
    """Content of a compressed run: each byte comes from the whole run."""
    return Content(data, np.broadcast_to(np.int64(start), len(data)), np.broadcast_to(np.int64(end), len(data)))


def _scan_layers(work: list[Layer | Content], limit: int, spans: set[tuple[str, int, int]]) -> None:
    """Add the spans of layers and of all that they hold."""
    seen: set[tuple[bytes, int]] = set()

    def scan_pieces(pieces: Iterable[bytes], start: int, end: Callable[[], int]) -> None:
        kinds: set[tuple[str, int, int]] = set()
        for piece in pieces:
            _scan_layers([_coarse(piece, 0, 1)], limit, kinds)
        found = {k for k, _, _ in kinds}
        spans.update((kind, start, end()) for kind in found)

    while work:
        item = work.pop()
        # The same content at the same place is the same layer, whichever way it was reached.
        raw = item.data if isinstance(item, Content) else item.text.encode("utf-8", "surrogatepass")
        key = (hashlib.blake2b(raw, person=type(item).__name__.encode()).digest(), int(item.starts[0]) if len(raw) else -1)
        if key in seen:
            continue
        seen.add(key)
        if isinstance(item, Content):
            if _is_stream(item.data):
                start, end = int(item.starts.min()), int(item.ends.max())
                unpacked = _Unpacked(_chunks(item.data), True)
                first, pieces = _unpack(unpacked, limit)
                if pieces is None:
                    work.append(_coarse(first, start, end))
                else:
                    scan_pieces(pieces, start, lambda end=end: end)
                if unpacked.used == len(item.data):
                    continue
            work += _as_texts(item)
            continue
        for kind, a, z in base_spans(item.text):
            if item.decoded[a:z].any():
                spans.add((kind, int(item.starts[a:z].min()), int(item.ends[a:z].max())))
        work += _next_layers(item, limit)
        for a, form, first, pieces, unpacked in _byte_streams(item, limit):
            start = int(form.starts[a])
            if pieces is None:
                work.append(_coarse(first, start, int(form.ends[a + unpacked.used - 1])))
            else:
                scan_pieces(pieces, start, lambda a=a, f=form, u=unpacked: int(f.ends[a + u.used - 1]))


def all_spans(text: str, limit: int = MOST_UNPACKED) -> list[tuple[str, int, int]]:
    """Base spans and those of all nested layers, in order of start, kind and end."""
    place = np.arange(len(text), dtype=np.int64)
    spans = set(base_spans(text))
    _scan_layers([Layer(text, place, place + 1, np.zeros(len(text), bool))], limit, spans)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _longest_run(member: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The longest run of marked bytes in each text; a run ends where its text does."""
    border = np.zeros(len(member) + 1, bool)
    border[offsets] = True
    a = np.flatnonzero(member & (border[:-1] | ~np.r_[False, member[:-1]]))
    z = np.flatnonzero(member & (border[1:] | ~np.r_[member[1:], False])) + 1
    out = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(out, np.searchsorted(offsets, a, side="right") - 1, z - a)
    return out


_ALPHABET = np.zeros(256, bool)
_ALPHABET[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", np.uint8)] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[np.frombuffer(b"=:%\\&", np.uint8)] = True


# The first characters of streams that stand in a text byte by byte, as UTF-8. Those of bzip2 hold an "&".
_HEADS = [tuple(head.encode()) for head in ("\x1f\x8b", "x\x01", "x^", "x\x9c", "x\xda", "\xfd7z", "(\xb5/")]


def _stream_heads(data: np.ndarray) -> np.ndarray:
    """Marks the bytes at which such a head begins."""
    found = np.zeros(len(data), bool)
    for head in _HEADS:
        n = len(data) - len(head) + 1
        if n > 0:
            here = data[:n] == head[0]
            for i, byte in enumerate(head[1:], 1):
                here &= data[i : n + i] == byte
            found[:n] |= here
    return found


def worth_reading(column: pa.Array) -> np.ndarray:
    """Marks texts that can hold a span: they have a sign that patterns and escapes need, the head of a compressed
    stream, or a long run of base64 letters.

    Access keys and long hexadecimal runs are runs of that alphabet themselves.
    """
    data, offsets = raw_bytes(column)
    signs = np.concatenate([[0], np.cumsum(_SIGNS[data] | _stream_heads(data))])
    some = signs[offsets[1:]] > signs[offsets[:-1]]
    return some | (_longest_run(_ALPHABET[data], offsets) >= _SHORTEST_BASE64) if len(data) else some


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for kind, a, z in spans)


SCAN = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string,masked:string>"


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind in brackets; overlapping spans go as one, under the first one's kind."""
    out, at = [], 0
    for kind, a, z in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, z)
    return "".join(out) + text[at:]


def _scan(column: pa.Array, with_mask: bool) -> pa.Array:
    read = worth_reading(column)
    n = len(column)
    counts = {kind: np.zeros(n, np.int64) for kind in KINDS}
    empty = hashlib.sha256(b"").hexdigest()
    digests, spans = [empty] * n, [""] * n
    masked: list[str | None] = [None] * n
    for i in np.flatnonzero(read).tolist():
        text = column[i].as_py() or ""
        base = sorted(base_spans(text), key=lambda s: (s[1], KINDS.index(s[0])))
        every = all_spans(text)
        for kind, _, _ in base:
            counts[kind][i] += 1
        digests[i], spans[i] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)
        if with_mask and every:
            masked[i] = mask(text, every)
    return struct_array(
        n_assign=pa.array(counts["assign"]),
        n_access=pa.array(counts["access"]),
        n_hex=pa.array(counts["hex"]),
        base_sha256=pa.array(digests, pa.string()),
        spans=pa.array(spans, pa.string()),
        masked=pa.array(masked, pa.string()),
    )


def scan_secrets(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts and digest, and all spans."""
    scan = text_column(lambda column, _: _scan(column, False), SCAN)
    return documents.select("doc_id", scan("text").alias("m")).select("doc_id", "m.*").drop("masked")


def mask_secrets(documents: DataFrame) -> DataFrame:
    """The documents with every span of their texts masked; all columns stay, ``n_chars`` follows the text."""
    from pyspark.sql import functions as F

    masked = text_column(lambda column, _: _scan(column, True), SCAN)("text")["masked"]
    changed = documents.withColumn("text", F.coalesce(masked, F.col("text")))
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return changed.select(*documents.columns)
