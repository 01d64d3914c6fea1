"""Near words against comparing all pairs."""

import random

import pytest

from eventide.llm import queries, variants
from tests.llm.test_operators import none, odd  # noqa: F401


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        top = min(near, key=lambda v: (-counts[v], v), default=None)
        form = top if top is not None and counts[top] >= 2 * n else None
        out[w] = (form, n, len(near), counts.get(form))
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w] += (root,)
    return out


@pytest.mark.parametrize("part_grams", [variants.PART_GRAMS, 3])
@pytest.mark.parametrize("letters", ["ab", "abcé", "ÿ×"])
def test_groups_equal_all_pairs(spark, letters, part_grams):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(150)}
    counts = {w: rng.choice([1, 2, 2, 4, 9, 20, 50]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"])
           for r in variants.group_variants(table, part_grams=part_grams).collect()}
    assert got == brute(counts)


def test_a_hot_key_is_split(spark):
    """All words share their first half: its key is dealt over parts, and each pair comes once."""
    words = [f"hothot{a}{b}{c}{d}" for a in "abcdef" for b in "abcdef" for c in "abcde" for d in "ab"]
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [(r["word"], r["other"]) for r in variants.near_pairs(table, part_grams=20).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_chains_end_at_their_last_word(spark):
    counts = {"abcde" + "x" * k: 2 ** (k + 2) for k in range(12)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = variants.group_variants(table).collect()
    assert {r["root"] for r in got} == {"abcde" + "x" * 11}


def test_dominance_must_make_chains_end(none):  # noqa: F811
    with pytest.raises(ValueError):
        variants.group_variants(none, dominance=1)


def test_odd_rows(odd, none):  # noqa: F811
    got = {r["word"]: tuple(r)[1:] for r in variants.group_variants(
        variants.frequent_words(queries.with_planted_slips(odd), least_chars=4, least_count=1)).collect()}
    assert {"spain": (None, "spain", 20_000, 0, None), "here": (None, "here", 4, 0, None)}.items() <= got.items()
    empty = variants.group_variants(variants.frequent_words(queries.with_planted_slips(none)))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
