"""License scan: every window that meets a template, against counting them one by one."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import licenses, queries
from eventide.llm.licenses import Template
from tests.conftest import SF0001
from tests.llm.test_operators import DOCS, none, odd  # noqa: F401

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, templates, stretch=1.0):
    """(template, start, containment) of every block that meets a template."""
    w, found = words_of(text), set()
    for number, t in enumerate(templates):
        span, whole = t.span(stretch), set(t.words)
        if t.ordered:
            found |= {(number, s, 1.0) for s in range(len(w) - span + 1) if w[s : s + span] == t.words}
            continue
        for s in range(max(len(w) - span, 0) + 1):
            shared = len(whole & set(w[s : s + span]))
            if shared >= t.need:
                found.add((number, s, shared / len(whole)))
    return found


TEMPLATES = [
    Template("one", "a b c d e"), Template("two", "b b a f", threshold=0.6), Template("three", "a b a", ordered=True),
    Template("four", "c é", ordered=True), Template("five", "e", threshold=1.0),
    Template("six", "f e d c b a f e d c b a", threshold=0.9),
]


@pytest.mark.parametrize("stretch", [1.0, 1.5])
def test_windows_equal_counting_each(spark, stretch):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("A b c d e f é x".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = licenses.matching_windows(docs, TEMPLATES, stretch).select("_id", "template", "start", "containment").collect()
    assert len(got) == len(set(got))  # each window once, whatever number of its words are met
    want = {(i, *f) for i, t in enumerate(texts) for f in brute(t, TEMPLATES, stretch)}
    assert {tuple(r) for r in got} == want and len(want) > 300


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f g".split()), min_size=1, max_size=9), st.floats(0.1, 1.0))
def test_prefix_holds_a_word_of_every_meeting_block(words, threshold):
    t = Template("x", " ".join(words), threshold)
    counts = {w: ord(w) for w in t.words}
    prefix = {row[0] for row in licenses._prefixes([t], counts, 1.0)}
    for mask in range(128):
        block = {w for i, w in enumerate("a b c d e f g".split()) if mask >> i & 1}
        if len(block & set(t.words)) >= t.need:
            assert block & prefix


def test_blocks_are_put_together(spark):
    mit = licenses.NOTICES[0].text
    text = "intro words here " + mit + " and more text " + " between " * 200 + mit.replace("charge", "cost")
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = licenses.license_blocks(docs).orderBy("first_word").collect()
    assert [(r["label"], r["template"]) for r in got] == [("mit", 3), ("mit", 3)]
    assert got[0]["containment"] == 1.0 and 0.8 <= got[1]["containment"] < 1.0
    assert got[0]["first_word"] <= 3 and got[0]["end_word"] >= 3 + len(licenses.NOTICES[0].words)


def test_odd_rows(odd, none, spark):  # noqa: F811
    rows = licenses.scan(odd).collect()
    assert len(rows) == 10
    assert all((r["n_places"], r["labels"], r["score"], r["first_word"]) == (0, [], 0.0, None) for r in rows)
    assert sorted(r["n_words"] for r in rows) == [0, 0, 0, 0, 4, 4, 4, 4, 5, 80_000]
    assert licenses.scan(none).count() == 0 and licenses.license_blocks(none).count() == 0
    long = "the of " * 50_000 + "Released under the MIT\nLicense. " * 3
    clash = spark.createDataFrame(
        [(1, long, "en", "s", 1, "w", "d", 7), (1, long, "en", "s", 1, "w", "d", 7), (None, "CC BY-NC", None, None, None, None, None, None)],
        DOCS,
    )
    got = licenses.scan(clash).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["n_places"], r["first_word"], r["place_labels"]) for r in got] == [
        (None, 1, 0, ["cc-by-nc"]), (1, 3, 100_001, ["mit"]), (1, 3, 100_001, ["mit"])
    ]
    assert licenses.with_license(clash).columns == clash.columns
    assert licenses.with_license(clash.unionByName(odd)).count() == 3


def test_templates_are_checked(odd):  # noqa: F811
    with pytest.raises(ValueError):
        licenses.scan(odd, [Template("x", "...")])
    with pytest.raises(ValueError):
        licenses.scan(odd, [Template("x", " ".join(map(str, range(licenses.MAX_WORDS + 1))))])


def test_query_labels_the_planted_lines_only(spark):
    got = {r["doc_id"]: r for r in queries.op11_license_scan(spark, SF0001).collect()}
    marks = {
        "GNU General Public License, version 3": "gpl-3", "CC BY-NC 4.0": "cc-by-nc",
        "the MIT License": "mit", "Apache License, Version 2.0": "apache-2",
    }
    docs = queries.read_table(spark, SF0001, "documents").select("doc_id", "text").collect()
    for doc_id, text in docs:
        want = sorted({label for mark, label in marks.items() if mark in (text or "")})
        assert got[doc_id]["labels"] == ",".join(want)


def test_no_python_on_the_path(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string").where(F.col("doc_id") > 0)
    plan = licenses.scan(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
