"""Runs of words against looking at every start and period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import periodic, queries
from tests.conftest import SF0001
from tests.llm.test_operators import none, odd  # noqa: F401


def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            part = words[at : at + length]
            if end > at and length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


blocks = st.lists(st.tuples(st.lists(st.sampled_from("ab c".split() + ["d"]), min_size=1, max_size=9), st.integers(1, 7)), max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=4))
def test_runs_equal_brute_force(texts):
    split = [[w for unit, times in t for w in unit * times] for t in texts]
    got = periodic.run_texts([" ".join(w) for w in split])
    for words, (_, row) in zip(split, got.iterrows()):
        runs = list(zip(row["starts"], row["lengths"], row["periods"]))
        assert runs == brute_runs(words)
        assert row["collapsed"] == brute_collapsed(words, runs) and row["n_words"] == len(words)
        if runs:
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
            assert runs[row["strongest"]] == best


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    for _ in range(400):
        words = []
        for _ in range(rng.randint(1, 3)):
            unit = [rng.randint(0, rng.choice([1, 3, 50])) for _ in range(rng.randint(1, 40))]
            words += (unit * 9)[: rng.randint(1, 300)]
        assert periodic.find_runs(np.array(words)) == brute_runs(words)


def test_very_long_texts():
    unit = [f"w{i}" for i in range(10_000)]
    text = "start " + " ".join(unit * 5) + " end"
    row = periodic.run_texts([text]).iloc[0]
    assert (row["starts"], row["lengths"], row["periods"]) == ([1], [50_000], [10_000])
    assert row["collapsed"] == "start " + " ".join(unit) + " end"


def test_words_split_at_ascii_white_space_only():
    assert periodic.split_words("a\x1cb c d\x0be\tf") == ["a\x1cb".encode(), "c d".encode(), b"e", b"f"]


def test_odd_rows(odd, none):  # noqa: F811
    got = [r["r"] for r in odd.select(periodic.periodic_runs("text").alias("r")).collect()]
    assert [r["n_words"] for r in got] == [4, 4, 4, 0, 0, 4, 0, 80_000, 0, 5]
    assert [len(r["starts"]) for r in got] == [0, 0, 0, 0, 0, 0, 0, 1, 0, 0]
    assert got[7]["collapsed"] == "the rain in spain" and got[7]["periods"] == [4]
    assert [r["strongest"] for r in got] == [None] * 7 + [0] + [None] * 2
    assert none.select(periodic.periodic_runs("text")).count() == 0


def test_query_equals_brute_force_on_the_whole_table(spark):
    docs = queries.read_table(spark, SF0001, "documents").select("doc_id", "text").collect()
    got = {r["doc_id"]: r.asDict() for r in queries.op12_periodic_runs(spark, SF0001).collect()}
    assert len(got) == len(docs)
    planted = 0
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words) if n < 2_500 else [tuple(map(int, r)) for r in periodic.find_runs(np.unique(words, return_inverse=True)[1])]
        start, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[doc_id] == {
            "doc_id": doc_id, "n_runs": len(runs), "start": start, "length": length, "period": q,
            "exponent_milli": length * 1000 // q if runs else None,
            "runs_sha256": digest("".join(f"{s},{k},{q}\n" for s, k, q in runs)),
            "collapsed_sha256": digest(brute_collapsed(words, runs)),
        }
    assert planted > 5
