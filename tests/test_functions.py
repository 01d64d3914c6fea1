"""Row functions: hash, url filter, word split, filters."""

from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.functions.hashing import BITMAP_BITS, HASH_SEED, poly_hash
from eventide.functions.text import exclude_static_assets, split_words


def poly_hash_py(s: str, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> int:
    """Reference implementation with explicit 32-bit wrap-around (tests only)."""
    h = 0
    for ch in s:
        h = (h * seed + ord(ch)) & 0xFFFFFFFF
    if h >= 1 << 31:
        h -= 1 << 32
    return (bits - 1) & h


def test_poly_hash_known_value(spark):
    assert poly_hash_py("543462") == 398203944
    df = spark.createDataFrame([("543462",), ("",), ("a",)], "s string")
    got = [r[0] for r in df.select(poly_hash("s")).collect()]
    assert got == [398203944, 0, poly_hash_py("a")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126), max_size=30), min_size=1, max_size=30))
def test_poly_hash_matches_32bit_emulation(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(poly_hash("s")).collect()]
    assert got == [poly_hash_py(v) for v in values]


def test_static_asset_filter(spark):
    urls = ["/a.css", "/a.css?x", "/a.js", "/css", "/a"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = sorted(r[0] for r in exclude_static_assets(df).collect())
    assert kept == ["/a", "/a.css?x", "/css"]


def test_word_split_drops_empty_tokens(spark):
    df = spark.createDataFrame([(1, "  a b\t\tb\nc \x0b d "), (2, "")], "doc_id long, text string")
    words = sorted(r["word"] for r in split_words(df).collect())
    assert words == ["a", "b", "b", "c", "d"]
