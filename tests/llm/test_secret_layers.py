"""Secrets under random nestings of encodings, and the ways a token is disguised."""

import base64
import bz2
import gzip
import json
import lzma
import random
import re
import time
import zlib

import pytest

from eventide.llm import queries, secret_scan
from tests.conftest import SF0001
from tests.llm.test_operators import none, odd  # noqa: F401

SECRET = "password=hunter22x"


def added(text, kind="assign"):
    return [(s["start"], s["end"]) for s in secret_scan.secrets(text) if s["kind"] == kind and not s["base"]]


def b64(raw, rng):
    return (base64.b64encode if rng.random() < 0.5 else base64.urlsafe_b64encode)(raw).decode()


def wrapped(text, rng):
    if "\n" in text or not text.isascii():
        return text
    width, end = rng.choice([20, 40, 64, 76]), rng.choice(["\n", "\r\n", "\\n", "\\r\\n"])
    return end.join(text[i : i + width] for i in range(0, len(text), width))


PACKS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress]
LAYERS = {
    "url": lambda t, rng: "".join(f"%{b:02X}" if rng.random() < 0.6 or chr(b) in "%=:&\\" else chr(b) for b in t.encode()),
    "url all": lambda t, rng: "".join(f"%{b:02x}" for b in t.encode()),
    "percent u": lambda t, rng: "".join(f"%u{ord(c):04X}" for c in t),
    "json": lambda t, rng: "".join(f"\\u{ord(c):04x}" for c in t),
    "braces": lambda t, rng: "".join(f"\\u{{{ord(c):x}}}" for c in t),
    "hex": lambda t, rng: "".join(f"\\x{b:02x}" for b in t.encode()),
    "decimal": lambda t, rng: "".join(f"&#{ord(c)};" for c in t),
    "named": lambda t, rng: t.replace("&", "&amp;").replace("=", "&equals;").replace("%", "&percnt;"),
    "base64": lambda t, rng: b64(t.encode(), rng),
    "packed": lambda t, rng: b64(rng.choice(PACKS)(t.encode()), rng),
    "packed twice": lambda t, rng: b64(rng.choice(PACKS)(rng.choice(PACKS)(t.encode())), rng),
    "packed thrice": lambda t, rng: b64(rng.choice(PACKS)(rng.choice(PACKS)(rng.choice(PACKS)(t.encode()))), rng),
    "wrapped": lambda t, rng: wrapped(b64(("x" * rng.randrange(70) + " " + t + " .").encode(), rng), rng),
}


@pytest.mark.parametrize("seed", range(120))
def test_random_nestings(seed):
    """Encode some layers over the secret: a span comes up, and lies within what was encoded."""
    rng = random.Random(seed)
    token = SECRET
    for _ in range(rng.randint(1, 4)):
        name = rng.choice(list(LAYERS))
        if len(token) < 4_000:
            token = LAYERS[name](token, rng)
    if token == SECRET:
        return
    text = f"some words, {token} .\nand more"
    found = added(text)
    assert found, token[:200]
    assert all(12 <= a < b <= 12 + len(token) for a, b in found)


@pytest.mark.parametrize("glue", ["a/", "id_", "x-", "Bearer-", "ab", "abc", "https/www_x-", "session_id-1_"])
@pytest.mark.parametrize("pack", [None, gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_text_glued_to_a_token(glue, pack):
    raw = f"{SECRET} ".encode()
    token = base64.urlsafe_b64encode(pack(raw) if pack else raw).decode()
    found = added(f"see {glue}{token} there")
    assert found and all(4 <= a < b <= 4 + len(glue) + len(token) for a, b in found)


@pytest.mark.parametrize("unit", ["%u003D", "\\u{3d}", "&equals;", "&#61", "&#61;", "&#x3D;", "&#X3d", "\\u003D", "\\x3d", "%3d"])
def test_spellings_of_an_escape(unit):
    assert added(f"my password{unit}hunter22x, so") == [(3, 11 + len(unit) + 9)]


def test_a_json_text_of_wrapped_lines():
    body = base64.b64encode(b"0123456789 " * 9 + SECRET.encode() + b" and so on " * 5).decode()
    lines = "\n".join(body[i : i + 64] for i in range(0, len(body), 64))
    assert added(json.dumps({"key": lines}))


def test_two_short_lines_are_one_token():
    body = base64.b64encode(b"key password=" + b"hunter22x").decode()
    assert added(f"{body[:20]}\n{body[20:]} end")


def test_deep_escapes_take_time_in_proportion():
    for text in ("%" + "25" * 500_000 + "41", ("%" + "25" * 20 + "3D ") * 10_000, "&" + "amp;" * 200_000 + "equals;"):
        start = time.process_time()
        secret_scan.secrets(text)
        assert time.process_time() - start < 60
    for depth in (1, 15, 16, 17, 18, 40, 2_000):
        deep = "password%" + "25" * depth + "3Dhunter22x"
        assert added(deep)[-1:] == [(0, len(deep))], depth
        mixed = "password" + "&" + "amp;" * depth + "equals;hunter22x"
        assert added(mixed) == [(0, len(mixed))], depth


def test_settled_text_equals_repeated_decoding():
    """Deep escapes in place against decoding the whole text until nothing changes."""
    rng = random.Random(2)
    bits = ["%", "25", "3D", "&", "amp;", "#61;", "\\", "u00", "5c", "x41", "é", "%C3%A9", "%C3", "%u0025", "lt;", "a b", "%e2%82%ac"]
    import numpy as np
    for _ in range(600):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        places = np.arange(len(text) + 1)
        layer = secret_scan.Layer(text, places[:-1], places[1:])
        settled = next(secret_scan._settled(layer), layer)
        assert len(settled.low) == len(settled.high) == len(settled.text)
        assert (settled.low < settled.high).all()
        again = next(secret_scan._settled(settled), None)
        assert again is None  # nothing is left to decode
        if not re.search("[éÃ�]", text + settled.text):
            whole = text
            for _ in range(40):
                whole = re.sub("|".join([secret_scan.URL_UNIT.pattern, secret_scan.UNICODE_UNIT.pattern]),
                               lambda m: secret_scan._plain(m[0]), whole)
            assert settled.text == whole or "&" in whole or "\\" in whole or "%" in whole


def test_a_stream_without_breaks_is_read_whole(monkeypatch):
    """One base64 token of many windows inside a compressed stream."""
    monkeypatch.setattr(secret_scan, "WINDOW", 1_000)
    rng = random.Random(1)
    inner = base64.b64encode(rng.randbytes(90_000) + f" {SECRET} ".encode() + rng.randbytes(3_000)).decode()
    for joined in (inner, "\n".join(inner[i : i + 76] for i in range(0, len(inner), 76))):
        token = base64.b64encode(gzip.compress(joined.encode())).decode()
        assert (2, 2 + len(token)) in added(f"a {token} b")
    spread = "x, " * 3_000 + "password" + " " * 5_000 + "= hunter22x" + " y." * 500
    token = base64.b64encode(gzip.compress(spread.encode())).decode()
    assert added(f"a {token} b") == [(2, 2 + len(token))]


def test_streams_that_hold_themselves_end(monkeypatch):
    """A stream whose content is a stream seen before is not followed further."""
    steps = []
    first = gzip.compress(b"one")

    def looping(chunks):
        for chunk in chunks:
            steps.append(1)
            yield first if chunk == first else chunk

    monkeypatch.setattr(secret_scan, "_content", looping)
    list(secret_scan._inflated(first, None, secret_scan.Layer("", [0], [1])))
    assert len(steps) <= 3


def test_query_gives_base_spans_and_more_at_every_place(spark):
    """The query over the given table: base spans by the plain rule, all spans by the operator."""
    docs = {r["doc_id"]: r["text"] for r in queries.read_table(spark, SF0001, "documents").collect()}
    rows = queries.op8_secret_scan(spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = secret_scan.secrets(docs[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s["base"] and s["kind"] == k for s in spans) for k in secret_scan.KINDS]
        assert r["spans"] == ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)


def test_repeated_rows_and_extra_columns(spark, odd, none):  # noqa: F811
    once = base64.b64encode(SECRET.encode()).decode()
    docs = spark.createDataFrame([(1, once, "a"), (1, once, "a"), (None, None, None)], "doc_id long, text string, spans string")
    got = docs.withColumn("found", secret_scan.find_secrets("text"))
    assert got.columns == ["doc_id", "text", "spans", "found"]
    assert sorted(len(r["found"]) for r in got.collect()) == [0, 1, 1]
    assert none.select(secret_scan.find_secrets("text")).count() == 0
