"""Secret scan with a recursive decoding worklist.

Three kinds of secrets are searched in the whole text (the base spans).  Then a
worklist starts.  All URL escapes of a text are put in plain as one layer, so are
all Unicode escapes and character references; each base64 token, also one wrapped
over lines of equal width (ends of lines may be escaped), is a layer of its bytes,
whatever they are, read at each of the four places where its groups of four may
begin, so text glued in front does not hide it.  Each layer is scanned for the
same kinds and unwrapped further, until nothing new comes up.  A gzip, zlib,
bzip2 or xz stream in such bytes gives its content, all members of it, and if that is
a stream again, its content, and so on.  A layer whose text was seen before at the
same place of the document is not unwrapped again, so cycles end, and so does a
stream that holds one it came from; the same token at another place is unwrapped
there too.  Each layer carries, for each of its characters, the range of the
document's characters it came from (a decompressed layer: the whole blob), so spans
found inside map back to the text.

Escapes within escapes are layers of the whole text up to ``ROUNDS`` deep.  What
is nested deeper is put in plain in place, from the left, each unit with what it
gives, until no unit is left, and scanned once: time follows the escaped
characters, not depth times length.

A stream's content is read in windows that end where no token, no escape and no
assignment goes on; a window grows until there is such a place.

Defined results: null and empty texts have no spans; texts and tokens of any length
are read whole; spans are in code points, end exclusive, ordered by start, then kind,
then end; a span that several layers give is listed once; added spans that equal a
base span are not added; equal rows get equal spans; an empty table gives no rows.
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
from bisect import bisect_left
from collections.abc import Generator, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW, STEP = 4 << 20, 1 << 20

#: Layers of escapes that are scanned one by one.
ROUNDS = 16

#: The kinds in their order, what to look for, and how long a hit must be.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the length can be part of the pattern
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
LINE_END = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
TAIL = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
URL_UNIT = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:%u[0-9A-Fa-f]{4})+")
UNICODE_UNIT = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?|&[A-Za-z][A-Za-z0-9]{1,31};"
)
ONE_UNIT = re.compile(
    r"%[c-dC-D][0-9A-Fa-f]%[89abAB][0-9A-Fa-f]|%[eE][0-9A-Fa-f](?:%[89abAB][0-9A-Fa-f]){2}|"
    r"%[fF][0-7](?:%[89abAB][0-9A-Fa-f]){3}|%[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4}(?:%u[dD][c-fC-F][0-9A-Fa-f]{2})?|\\u[0-9A-Fa-f]{4}(?:\\u[dD][c-fC-F][0-9A-Fa-f]{2})?|"
    r"\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,9};?|&#[xX][0-9A-Fa-f]{1,8};?|&[A-Za-z][A-Za-z0-9]{1,31};"
)
LONGEST_UNIT = 34
STREAM = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00")
#: Bytes without any of this hold no secret and nothing to unwrap.
TELLING = re.compile(
    rb"(?i:passw|secret|token|key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-fu]{2}|\\[ux]|&[#A-Za-z]|[A-Za-z0-9+/_-]{16}|" + STREAM.pattern
)
#: A window may end behind such a character: no token, escape or line end goes over it.
BREAK = re.compile(r"[,.\"'<>()\[\]!?*|~^$@`](?=[^\s\"'])")

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


class Layer(NamedTuple):
    text: str
    low: np.ndarray  # per character, where its source starts in the document
    high: np.ndarray  # and where it ends


def scan(text: str) -> list[tuple[str, int, int]]:
    """Hits of all kinds in a text, leftmost and non-overlapping per kind."""
    found = []
    if (":" in text or "=" in text) and _may_assign(text):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _may_assign(text: str) -> bool:
    low = text.lower()
    return "passw" in low or "secret" in low or "token" in low or "key" in low


def secrets(text: str | None) -> list[dict]:
    """All spans of a document, base spans and those from its layers."""
    text = text or ""
    base = scan(text)
    added: set[tuple[str, int, int]] = set()
    seen: set[tuple[bytes, int, int]] = set()  # a layer's text and its place: the same token elsewhere is another layer
    tried: set[tuple[bytes, int, int]] = set()  # the same of base64 tokens
    places = np.arange(len(text) + 1, dtype=np.int32)
    work: list[tuple[Layer | Iterator[Layer], int]] = _unwrapped(Layer(text, places[:-1], places[1:]), tried, 0)
    while work:
        layer, depth = work.pop()
        if not isinstance(layer, Layer):
            window = next(layer, None)
            if window is None:
                continue
            work.append((layer, depth))
            layer = window
        if not layer.text or not _new(layer, seen):
            continue
        for kind, a, b in scan(layer.text):
            added.add((kind, int(layer.low[a]), int(layer.high[b - 1])))
        work += _unwrapped(layer, tried, depth)
    spans = [(a, KINDS.index(k), b, True) for k, a, b in base]
    spans += [(a, KINDS.index(k), b, False) for k, a, b in added - set(base)]
    return [{"kind": KINDS[k], "start": a, "end": b, "base": own} for a, k, b, own in sorted(spans)]


def _new(layer: Layer, seen: set[tuple[bytes, int, int]]) -> bool:
    digest = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    place = (digest, int(layer.low[0]), int(layer.high[-1]))
    if place in seen:
        return False
    seen.add(place)
    return True


def _unwrapped(layer: Layer, tried: set[tuple[bytes, int, int]], depth: int) -> list[tuple[Layer | Iterator[Layer], int]]:
    """The layers that one step of decoding gives, and how many steps of escapes lie behind them."""
    out: list[tuple[Layer | Iterator[Layer], int]] = []
    if depth < ROUNDS:
        if "%" in layer.text:
            out += [(x, depth + 1) for x in _replaced(layer, URL_UNIT)]
        if "\\" in layer.text or "&" in layer.text:
            out += [(x, depth + 1) for x in _replaced(layer, UNICODE_UNIT)]
    elif depth == ROUNDS:
        out += [(x, depth + 1) for x in _settled(layer)]
    for spans in _tokens(layer.text):
        token = Layer(
            "".join(layer.text[a:b] for a, b in spans),
            np.concatenate([layer.low[a:b] for a, b in spans]), np.concatenate([layer.high[a:b] for a, b in spans]),
        )
        if _new(token, tried):
            out.append((_base64(token), 0))
    return out


def _tokens(text: str) -> Iterator[list[tuple[int, int]]]:
    """Where base64 tokens may lie: single runs, and runs of equal width on lines that follow each other."""
    at = 0
    while (m := BASE64.search(text, at)) is not None:
        a, at = m.span()
        yield [(a, at)]
        if a and text[a - 1] == "\\" and text[a] in "nr":
            a += 1  # the letter may belong to an escaped end of line
        block, width, whole = [(a, at)], at - a, True
        while whole and text[at - 1] != "=":
            line_end = LINE_END.match(text, at)
            tail = TAIL.match(text, line_end.end()) if line_end else None
            if tail is None or len(tail[0]) > width:
                break
            block.append(tail.span())
            whole = len(tail[0]) == width
            if whole:
                yield [tail.span()]
                at = tail.end()
            else:
                at = tail.start()  # a shorter line ends the token, and may begin another
        if len(block) > 1:
            yield block
            if not whole and len(block) > 2:
                yield block[:-1]


def _plain(unit: str) -> str:
    """What an escaped unit, or a row of them, stands for."""
    if unit[0] == "%" and unit[1] != "u":
        return bytes.fromhex(unit.replace("%", "")).decode("utf-8", "replace")
    if unit[0] == "&":
        return html.unescape(unit)
    if unit[1] == "x":
        return chr(int(unit[2:], 16))
    if unit[2] == "{":
        code = int(unit[3:-1], 16)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"
    units = b"".join(int(u, 16).to_bytes(2, "big") for u in unit.split(unit[:2])[1:])
    return units.decode("utf-16-be", "replace")


def _replaced(layer: Layer, unit: re.Pattern) -> Iterator[Layer]:
    """The layer with each escaped unit put in plain; its characters come from the whole unit."""
    parts, low, high, at = [], [], [], 0
    for m in unit.finditer(layer.text):
        a, b = m.span()
        put = _plain(m[0])
        parts += [layer.text[at:a], put]
        low += [layer.low[at:a], np.broadcast_to(layer.low[a], len(put))]
        high += [layer.high[at:a], np.broadcast_to(layer.high[b - 1], len(put))]
        at = b
    if at:
        yield Layer(
            "".join(parts) + layer.text[at:], np.concatenate([*low, layer.low[at:]]), np.concatenate([*high, layer.high[at:]])
        )


def _settled(layer: Layer) -> Iterator[Layer]:
    """The layer with its units put in plain, and those that this makes, until there is none.

    From the left: what a unit gives is read again together with what follows it and
    with an unfinished unit before it, so each step costs one unit's length.
    """
    text, n = layer.text, len(layer.text)
    left: list[tuple[str, int, int]] = []  # done: character and its source
    front: list[tuple[str, int, int]] = []  # to be read before the rest of the text, the next one last
    opened: list[int] = []  # places in ``left`` of characters that may begin a unit
    at, changed = 0, False
    while front or at < n:
        if not front:  # up to the next character that may begin a unit, nothing can change
            ends = [k for k in (text.find(c, at) for c in "%\\&") if k >= 0]
            stop = min(ends, default=n)
            left += zip(text[at:stop], layer.low[at:stop].tolist(), layer.high[at:stop].tolist())
            at = stop
            if at >= n:
                break
        ahead = "".join(c for c, _, _ in reversed(front[-LONGEST_UNIT:])) + text[at : at + LONGEST_UNIT]
        m = ONE_UNIT.match(ahead)
        put = _plain(m[0]) if m else ""
        if not m or put == m[0]:
            if front:
                item = front.pop()
            else:
                item = (text[at], int(layer.low[at]), int(layer.high[at]))
                at += 1
            if item[0] in "%\\&":
                opened.append(len(left))
            left.append(item)
            continue
        taken = [front.pop() for _ in range(min(len(front), m.end()))]
        rest = m.end() - len(taken)
        low = taken[0][1] if taken else int(layer.low[at])
        high = max([t[2] for t in taken] + ([int(layer.high[at + rest - 1])] if rest else []))
        at, changed = at + rest, True
        front += [(c, low, high) for c in reversed(put)]
        near = bisect_left(opened, len(left) - LONGEST_UNIT)
        if near < len(opened):  # an unfinished unit before it may be complete now
            back = opened[near]
            front += reversed(left[back:])
            del left[back:], opened[near:]
    if changed:
        yield Layer("".join(c for c, _, _ in left), np.array([x[1] for x in left]), np.array([x[2] for x in left]))


def _base64(token: Layer) -> Iterator[Layer]:
    """The bytes of a token, one character each, at each place where they may begin, and the streams in them."""
    body = token.text.rstrip("=").replace("-", "+").replace("_", "/")
    for skip in range(4):
        part = body[skip:]
        if len(part) % 4 == 1:
            if skip == 0:
                continue  # no whole token; the other places drop what is over
            part = part[:-1]
        if len(part) < 12:
            continue
        try:
            raw = base64.b64decode(part + "=" * (-len(part) % 4))
        except binascii.Error:
            continue
        if TELLING.search(raw) is None and _decompressor(raw) is None:
            continue
        at = np.arange(len(raw))  # a byte came from the characters that share its bits
        high = np.minimum(-(-(at + 1) * 4 // 3), len(part)) - 1
        layer = Layer(raw.decode("latin-1"), token.low[skip + at * 4 // 3], token.high[skip + high])
        if _decompressor(raw) is None:
            yield layer
        elif (yield from _inflated(raw, layer, token)):
            return  # the token is a stream and nothing else
        for m in STREAM.finditer(raw, 1):
            if _decompressor(raw[m.start() : m.start() + 6]) is not None:
                yield from _inflated(raw[m.start() :], None, Layer("", layer.low[m.start() :], token.high))


def _inflated(raw: bytes, blob: Layer | None, token: Layer) -> Generator[Layer, None, bool]:
    """Windows over the content of a compressed stream, and of the streams it holds; returns whether it is whole.

    If it is not, ``blob`` (its bytes as they are) comes too.
    """
    low, high = token.low[0], token.high[-1]
    seen = {hashlib.blake2b(raw).digest()}
    for depth in itertools.count(1):
        stream: Iterator[bytes | None] = iter([raw])
        for _ in range(depth):
            stream = _content(stream)
        digest, head, whole = hashlib.blake2b(), b"", True
        held, wanted = "", WINDOW
        for part in stream:
            if part is None:
                whole = False
                break
            digest.update(part)
            head = head if len(head) >= 6 else head + part[:6]
            held += part.decode("latin-1")
            if len(held) < wanted:
                continue
            cut, keep = _window_end(held)
            if not cut:
                wanted = 2 * len(held)  # one token so far
                continue
            yield Layer(held[:cut], np.broadcast_to(low, cut), np.broadcast_to(high, cut))
            held, wanted = held[keep:], WINDOW
        yield Layer(held, np.broadcast_to(low, len(held)), np.broadcast_to(high, len(held)))
        if depth == 1:
            is_whole = whole
            if not whole and blob is not None:
                yield blob
        if _decompressor(head) is None or digest.digest() in seen:
            return is_whole
        seen.add(digest.digest())


def _window_end(text: str) -> tuple[int, int]:
    """Where a window may end, and where the next one begins; zeros if nowhere."""
    cut = _line_cut(text)
    if cut:
        return cut, cut
    for k in range(len(text) - 1, len(text) // 2, -1):
        if text[k - 1] in ",.\"'<>()[]!?*|~^$@`" and BREAK.match(text, k - 1):
            # What is before may be the name of an assignment that goes on behind it.
            return k, max(len(text[: k - 1].rstrip(" \"':=")) - LONGEST_UNIT, 1)
    return 0, 0


def _line_cut(text: str) -> int:
    """After the last line end that no token crosses, 0 if there is none."""
    end = text.rfind("\n")
    while end > 0:
        before = text[max(end - 2, 0) : end].rstrip("\r")
        if before and before[-1] not in LETTERS and not before[-1].isspace():
            return end + 1
        end = text.rfind("\n", 0, end)
    return 0


def _decompressor(raw: bytes):
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if raw[:1] == b"\x78" and len(raw) > 2 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _content(chunks: Iterator[bytes | None]) -> Iterator[bytes | None]:
    """What the members of a compressed stream hold, and what follows them; None where one can not be read on."""
    held = b""
    while True:
        while len(held) < 6 and (more := next(chunks, b"")):
            held += more
        member = _decompressor(held)
        if member is None:
            break
        try:
            while not member.eof:
                part = member.decompress(held, STEP)
                held = getattr(member, "unconsumed_tail", b"")
                if part:
                    yield part
                elif not held and not member.eof:
                    held = next(chunks, None) or b""
                    if not held:
                        yield None  # cut off
                        return
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            yield None
            return
        held = member.unused_data
    if held:
        yield held
    yield from chunks


def find_secrets(text: Column | str) -> Column:
    """Array of (kind, start, end, base) for the whole text of each row."""

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([secrets(t) for t in texts], dtype=object)

    return found(text)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
