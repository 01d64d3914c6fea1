"""Operators of the subpackage against brute force, round trips and held-out accuracy, on small tables."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import (
    chat, components, decontaminate, exact_dedup, html_text, language_id, nbest, oracle, pieces, queries, secret_scan,
    simhash, token_counts, toxicity,
)
from tests.conftest import SF001, SF0001

DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, digest string, _id long"
LONG = "the rain in spain " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, "Same text here now", "en", "s", 3, "w", "d", 9),
        (2, "Same text here now", "en", "s", 3, "w", "d", 9),
        (2, "Same text here now", "en", "s", 3, "w", "d", 9),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "s", 0, "w", "d", 9),
        (None, "Same text here now", "en", "s", 3, "w", "d", 9),
        (None, None, None, None, None, None, None, None),
        (5, LONG, "en", "s", 3, "w", "d", 9),
        (6, " \t\n", "de", "s", 3, "w", "d", 9),
        (7, "der die das und nicht", "de", "s", 3, "w", "d", 9),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- 1 language ---------------------------------------------------------------


def test_language_odd_rows(odd, none):
    profile = language_id.learn(odd)
    got = [r["p"] for r in odd.select(language_id.identify("text", profile).alias("p")).collect()]
    assert [r["lang_pred"] for r in got] == ["en", "en", "en", "und", "und", "en", "und", "en", "und", "de"]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert language_id.keep_known(odd, profile).columns == odd.columns
    assert none.select(language_id.identify("text", profile)).count() == 0
    empty = language_id.learn(none)
    assert empty == language_id.Profile((), ())
    assert language_id.predict(["abc"], empty).lang_pred.tolist() == ["und"]


def brute_phrases(text, sample):
    """Greedy longest phrases of ``text`` that occur in ``sample``, by substring search."""
    count = at = 0
    while at < len(text):
        n = 0
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at += max(n, 1)
        count += 1
    return count


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc xé", max_size=40), min_size=1, max_size=5), st.text("ab cé", min_size=3, max_size=60))
def test_language_phrases_against_substring_search(texts, sample):
    if not any(c.isalpha() for c in sample):
        return
    profile = language_id.Profile(("xx",), (sample,))
    bits, _ = language_id.parse_costs(texts, profile)

    def spaced(t):
        out = []
        for c in t.lower():
            c = c if c.isalpha() else " "
            if not (c == " " and out and out[-1] == " "):
                out.append(c)
        return "".join(out)

    plain = spaced(sample)
    want = [brute_phrases(spaced(t), plain) * np.log2(max(len(plain), 2)) for t in texts]
    assert np.allclose(bits[:, 0], want)


def test_language_blocks_cut_long_texts():
    profile = language_id.Profile(("en",), ("the rain in spain ",))
    bits, _ = language_id.parse_costs([LONG], profile)
    blocks = -(-len(LONG) // language_id.BLOCK)
    whole = brute_phrases(LONG[:4000], profile.samples[0]) * len(LONG) / 4000
    assert bits[0, 0] / np.log2(len(profile.samples[0])) <= whole + 2 * blocks


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc é", max_size=60), min_size=1, max_size=5), st.text("ab cé", min_size=3, max_size=60), st.integers(1, 9))
def test_language_phrases_run_over_block_borders(texts, sample, block):
    if not any(c.isalpha() for c in sample):
        return
    profile = language_id.Profile(("xx", "yy"), (sample, sample[::-1]))
    whole, _ = language_id.parse_costs(texts, profile)
    held, language_id.BLOCK = language_id.BLOCK, block
    try:
        cut, _ = language_id.parse_costs(texts, profile)
    finally:
        language_id.BLOCK = held
    assert np.array_equal(whole, cut)


def test_language_learns_from_whole_texts(spark):
    rows = [("en", "the " * 100 + f"end{i}") for i in range(9)] + [("de", "lang " * 20_000), ("de", "kurz " * 8_000), ("fr", "le mot")]
    docs = spark.createDataFrame([(t, lang) for lang, t in rows * 2], "text string, lang string")
    got = language_id.learn(docs, sample_docs=5, sample_chars=1_700)
    assert got.languages == ("de", "en", "fr") and got.samples[2] == "le mot"
    assert got.samples[0] == "kurz " * 8_000  # the shortest one, whole, where all are long
    assert got.samples[1].count("end") == 4 and len(got.samples[1]) <= 1_700 + 4


def test_language_held_out_accuracy(spark):
    got = queries.op1_language_id(spark, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


# --- 2 chat -------------------------------------------------------------------


def test_chat_folds_deltas_edits_and_regenerations(spark):
    log = spark.createDataFrame(
        [
            (1, 1, "message", 0, "user", "hi"),
            (1, 2, "message", 1, "assistant", ""),
            (1, 3, "delta", 1, None, "wro"),
            (1, 4, "delta", 1, None, "ng"),
            (1, 5, "regenerate", 1, None, None),
            (1, 6, "delta", 1, None, "ri"),
            (1, 7, "delta", 1, None, "ght"),
            (1, 8, "message", 2, "user", "more"),
            (1, 9, "edit", 0, None, "hello"),
            (1, 10, "message", 1, "assistant", "again"),
            (2, 1, "message", 0, None, None),
            (None, 1, "message", 0, "user", "x"),
        ],
        "conv_id long, seq long, kind string, msg long, role string, text string",
    )
    got = {(r["conv_id"], r["msg"]): (r["role"], r["text"]) for r in chat.fold_events(log).collect()}
    assert got == {
        (1, 0): ("user", "hello"), (1, 1): ("assistant", "again"), (2, 0): ("", ""), (None, 0): ("user", "x")
    }
    before = chat.fold_events(log.where("conv_id = 1 AND seq <= 8")).collect()
    assert {(r["msg"], r["text"]) for r in before} == {(0, "hi"), (1, "right"), (2, "more")}


NASTY = [*chat.CONTROL, "\\", "<", "|", "im_end|>", "\n", "é", "🙂", "<\\|im_end|>", "\\\\<|im_end|>\n", chat.LINE, ""]


def test_chat_read_back_is_exact(spark):
    rng = random.Random(1)
    text = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randrange(8)))
    rows = [
        (c, t, rng.choice(["user", "assistant", text()]), rng.choice([None, text(), text(), LONG[:3000]]))
        for c in range(40) for t in range(rng.randrange(1, 6))
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.fold_events(chat.rows_as_events(table)))
    back = chat.read_back(rendered).collect()
    want = sorted((c, t, r, x or "") for c, t, r, x in rows)
    assert [(r["role"], r["text"]) for r in sorted(back, key=lambda r: (r["conv_id"], r["pos"]))] == [x[2:] for x in want]
    digest = {r["conv_id"]: r for r in chat.digests(rendered).collect()}
    for c in {x[0] for x in want}:
        turns = [x for x in want if x[0] == c]
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        assert digest[c]["n_turns"] == len(turns)
        assert digest[c]["turns_sha256"] == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest()
        assert (digest[c]["loss_chars"], digest[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_repeated_turns_and_empty_log(spark):
    table = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None)], "conv_id long, turn long, role string, text string"
    )
    got = chat.digests(chat.render(chat.fold_events(chat.rows_as_events(table)))).collect()
    assert [r["n_turns"] for r in got] == [3]
    assert chat.digests(chat.render(chat.fold_events(chat.rows_as_events(table.limit(0))))).count() == 0


# --- 3 toxicity ---------------------------------------------------------------


def test_toxicity_restores_obfuscated_words():
    counts = toxicity._trigram_counts(["the idiot said a stupid thing and the loser left " * 20])
    model = toxicity.Model(toxicity._log_probabilities(counts, ["idiot", "stupid", "loser"]).tobytes(), (), 0.0, 0.0)
    plain, _ = toxicity._tables(model)
    for seen, meant in [("1d10t", "idiot"), ("i d i o t", "idiot"), ("st.u.p.i.d", "stupid"), ("$tup1d", "stupid"), ("looooser", "loser")]:
        assert toxicity.restore(seen, plain) == meant
    assert toxicity.restore("the plain text, no. 7", plain) == "the plain text, no. 7"
    assert toxicity.suspicious(["1d10t", "a b c d", "looo", "plain words here."]).tolist() == [True, True, True, False]


def test_toxicity_decoding_is_the_best_path():
    counts = toxicity._trigram_counts(["some words of plain text and more of it"])
    logp = toxicity._log_probabilities(counts, [])

    def cost(letters):
        """Of each word by itself: what is no letter ends one."""
        words = "".join(x if toxicity._symbol(x) else " " for x in letters).split()
        padded = [[0, 0, *map(toxicity._symbol, w), 0] for w in words]
        return sum(float(logp[a, b, c]) for s in padded for a, b, c in zip(s, s[1:], s[2:]))

    from itertools import product

    for span in ("1t", "w0rd", "m0r3", "p1a1n", "t3xttt", "w 0 r d", "m.0.r.3.0.f", "t e x t o f", "ttext5", "1", "o.f.!.i.t"):
        options = toxicity._options(span)
        best = max(cost("".join(x for x, _ in way)) - sum(c for _, c in way) for way in product(*options))
        got = toxicity.decode(span, logp)
        channel = min(
            sum(c for _, c in way) for way in product(*options) if "".join(x for x, _ in way) == got
        )
        assert cost(got) - channel == pytest.approx(best, abs=1e-4)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (7, 1, 1), (5, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(odd, labels, F.lit(True))
    scores = [r[0] for r in odd.select(toxicity.score("text", model)).collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
    unlabelled = toxicity.learn(none, labels.limit(0), F.lit(True))
    assert {r[0] for r in odd.select(toxicity.score("text", unlabelled)).collect()} == {0.0}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op3_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)


# --- 4 and 6 pieces -----------------------------------------------------------


def toy():
    names = ["a", "b", "c", "▁", "▁a", "ab", "bc", "abc", "▁ab", "ca", "▁▁"]
    costs = [900, 800, 700, 600, 500, 700, 650, 1200, 1000, 1400, 800]
    names += [f"<0x{b:02X}>" for b in range(256)]
    return pieces.Vocabulary(tuple(names), tuple(costs) + (5000,) * 256, tuple(range(11, 267)))


def all_ways(text, lat):
    """Every segmentation of a text as (weight, ids), by enumeration."""
    if not text:
        return [(0, ())]
    out = []
    for i, w in lat.edges(text, len(text)):
        out += [(v + w, ids + lat.ids(text[i:])) for v, ids in all_ways(text[:i], lat)]
    return out


@settings(max_examples=80, deadline=None)
@given(st.text("abc é\n▁", max_size=9))
def test_pieces_against_enumeration(text):
    vocabulary = toy()
    lat = pieces.lattice(vocabulary)
    ways = sorted(all_ways(" " + text, lat))
    (ids, costs), = nbest.Encoder(vocabulary, 4)([text])
    if not text:
        assert (len(ids), costs) == (0, [0])
        return
    assert costs == [w >> pieces.COUNT_BITS for w, _ in ways[:4]]
    assert tuple(ids.tolist()) in {i for w, i in ways if w == ways[0][0]}
    assert token_counts.count_texts([text], vocabulary).n_tokens[0] == len(ids)
    assert b"".join(lat.spelled[i] for i in ids).decode()[1:] == text
    for chunk in pieces.chunks(text):
        want = sorted(w >> pieces.COUNT_BITS for w, _ in all_ways(chunk, lat))[:3]
        assert [c for c, _ in nbest.n_best(chunk, lat, 3)] == want


@settings(max_examples=80, deadline=None)
@given(st.text("abc é\n▁", max_size=9))
def test_pieces_lists_the_segmentations_themselves(text):
    vocabulary = toy()
    lat = pieces.lattice(vocabulary)
    cost = {ids: w >> pieces.COUNT_BITS for w, ids in all_ways(" " + text, lat)} if text else {(): 0}
    (listed, costs), = nbest.Encoder(vocabulary, 4).n_best([text])
    got = [tuple(ids.tolist()) for ids in listed]
    assert len(set(got)) == len(got) == min(4, len(cost))
    assert [cost[ids] for ids in got] == costs == sorted(cost.values())[:4]
    assert all(nbest.spell(ids, vocabulary) == text for ids in listed)


def test_pieces_columns_and_pipeline_stage(spark, odd):
    from eventide.llm.common import prepare

    prepare(spark)
    assert corpus_pipeline.STAGES[-1] == ("SentencePiece encoding and decoding", corpus_pipeline.encode)
    plan = corpus_pipeline.encode(spark, odd, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert "restored" in plan and "raise_error" in plan
    vocabulary = pieces.load()
    for r in odd.select("text", nbest.encode("text", vocabulary, check=True).alias("e")).select("text", "e.*").collect():
        assert r["restored"]
        assert len(r["next_ids"]) == max(len(r["costs"]) - 1, 0)
        assert len({tuple(x) for x in [r["ids"] or [], *r["next_ids"]]}) == max(len(r["costs"]), 1)
        assert all(nbest.spell(np.array(x), vocabulary) == r["text"] for x in r["next_ids"])


def test_pieces_many_equal_ways_end():
    lat = pieces.lattice(toy())
    assert len(nbest.n_best("a" * 3000, lat, 4)) == 1  # one way only: a is in no pair with itself
    assert len(nbest.n_best("abc" * 1000, lat, 4)) == 4


@settings(max_examples=80, deadline=None)
@given(st.text("abc", max_size=9))
def test_pieces_ties_in_a_chunk(text):
    lat = pieces.lattice(toy())

    def ways(j):
        if not j:
            return [(0, (), ())]
        return [(v + w, (i, *starts), ids + lat.ids(text[i:j])) for i, w in lat.edges(text, j) for v, starts, ids in ways(i)]

    assert nbest.n_best(text, lat, 4) == [(w >> pieces.COUNT_BITS, ids) for w, _, ids in sorted(ways(len(text)))[:4]]


def test_pieces_one_unbroken_text_in_bounded_memory():
    import tracemalloc

    vocabulary = pieces.load()
    rng = random.Random(6)
    text = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=300_000))
    nbest.trie(vocabulary)
    tracemalloc.start()
    (listed, costs), = nbest.Encoder(vocabulary, 4).n_best([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(listed) == len(costs) == len({x.tobytes() for x in listed}) == 4
    assert all(nbest.spell(x, vocabulary) == text for x in listed)
    assert peak < 500 << 20


def test_pieces_lanes_equal_one_by_one():
    vocabulary = pieces.load()
    lat = pieces.lattice(vocabulary)
    found = sorted({c for t in (LONG[:200], "Öl für 漢字🙂 ▁x", " " * 40 + "a", "x" * 90, "\n\n") for c in pieces.chunks(t)})
    solved = nbest.solve(found, vocabulary)
    for k, chunk in enumerate(found):
        ids, cost, gap = nbest.best_and_gap(chunk, lat)
        assert tuple(solved.ids[solved.begin[k] : solved.begin[k + 1]].tolist()) == ids
        assert solved.cost[k] == cost
        assert solved.gap[k] == (nbest.FAR if gap is None else gap >> pieces.COUNT_BITS)


def test_pieces_odd_rows(odd, none):
    vocabulary = pieces.load()
    made = odd.select("text", nbest.encode("text", vocabulary).alias("e"), token_counts.token_counts("text", vocabulary).alias("n"))
    rows = made.select("text", "e.ids", "n.n_tokens", nbest.decode(F.col("e.ids"), vocabulary).alias("back")).collect()
    for r in rows:
        assert r["back"] == r["text"]
        assert r["n_tokens"] == len(r["ids"] or [])
    assert none.select(nbest.encode("text", vocabulary)).count() == 0


# --- 5 exact copies -----------------------------------------------------------


def test_exact_odd_rows(odd, none):
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(odd).collect()]
    order = lambda rows: sorted(rows, key=repr)
    assert order(got) == order([
        (1, 2, 4, False), (2, 2, 4, True), (2, 2, 4, True), (None, 2, 4, False),
        (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True),
    ])
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 6, 7]
    assert exact_dedup.exact_duplicates(none).count() == 0
    least = exact_dedup.exact_duplicates(odd, keep="min").where("kept").select("doc_id").distinct().collect()
    assert sorted(r[0] for r in least) == [1, 3, 5, 6, 7]


def test_exact_many_partitions(spark):
    rng = random.Random(3)
    rows = [(i, f"t{rng.randrange(40)}") for i in range(2000)]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(70)).collect()
    best, size = {}, {}
    for i, t in rows:
        best[t], size[t] = max(best.get(t, -1), i), size.get(t, 0) + 1
    text = dict(rows)
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {(i, best[text[i]], size[text[i]]) for i, _ in rows}


# --- 7 near copies ------------------------------------------------------------


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x1c", "X").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_simhash_links_against_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    changed = [x ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, k, replace=False).astype(np.uint64))
               for x in base[:200] for k in (1, 3, 6)]
    prints = np.unique(np.concatenate([base, np.array(changed, dtype=np.uint64)]))
    a, b = simhash.link(prints, radius)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    want = components_of(zip(*map(list, map(lambda x: prints[x].tolist(), np.nonzero(apart <= radius)))), prints.tolist())
    assert components_of(zip(a.tolist(), b.tolist()), prints.tolist()) == want


def test_simhash_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in rows}
    for r in rows[:40]:
        assert prints[r["doc_id"]] == brute_fingerprint(" ".join(r["text"].split()))
    ids = sorted(prints)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    want = components_of(pairs, ids)
    got = {r["doc_id"]: r for r in queries.op7_simhash(spark, SF0001).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints


def test_simhash_odd_rows(odd, none):
    got = {(r["_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    zero = "0" * 16
    assert {(3, zero, 3), (4, zero, 3), (6, zero, 3), (None, zero, 3)} <= got
    assert {c for i, _, c in got if i in (1, 2)} == {1}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 7]
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == components_of(edges, nodes)


# --- 8 secrets ----------------------------------------------------------------


def test_secrets_in_layers():
    secret = "password=hunter2hunter"
    once = base64.b64encode(secret.encode()).decode()
    packed = base64.b64encode(gzip.compress(secret.encode())).decode()
    twice = base64.b64encode(once.encode()).decode()
    for token in (once, packed, twice, "password%3Dhunter22", "pass\\u0077ord\\u003dhunter22", "pass%2577ord%3Dhunter22", "password&#61;hunter22"):
        text = f"some words {token} and more"
        found = [s for s in secret_scan.secrets(text) if s["kind"] == "assign" and not s["base"]]
        assert [s["start"] for s in found] == [text.index(token)]
        assert len(token) - 4 <= found[0]["end"] - found[0]["start"] <= len(token)


def test_secrets_of_equal_tokens_at_every_place():
    once = base64.b64encode(b"password=hunter2hunter").decode()
    for token in (once, base64.b64encode(once.encode()).decode(), "password%3Dhunter22"):
        text = f"{token} first\nthen {token}\n{token} last"
        found = [s["start"] for s in secret_scan.secrets(text) if s["kind"] == "assign" and not s["base"]]
        assert found == [0, len(token) + 12, 2 * len(token) + 13]
    assert secret_scan.secrets("&#abc;&#x1;") == []  # stays as it is, or spells nothing


def _added(text):
    return [(s["kind"], s["start"], s["end"]) for s in secret_scan.secrets(text) if not s["base"]]


def test_secrets_layers_are_whole(monkeypatch):
    for hit in ("password%3A hunter22x", "token&#61; abcdef123", "token: abc%64efgh"):
        assert _added(f"so {hit}, and") == [("assign", 3, 3 + len(hit))]
    plain = b"".join(b"%d," % i for i in range(40)) + b" password=hunter22x"
    for raw in (plain, b"\x00\xff\x01" + plain + b"\xfe", zlib.compress(plain, 0) * 2, gzip.compress(b"x" * 90) + gzip.compress(plain)):
        for width in (64, 76):
            token = base64.b64encode(raw).decode()
            for end in ("\n", "\r\n"):
                lines = end.join(token[i : i + width] for i in range(0, len(token), width))
                found = _added(f"-----BEGIN-----{end}{lines}{end}-----END-----")
                assert "assign" in {k for k, _, _ in found}
                assert all(15 <= a < b <= 15 + 2 * len(end) + len(lines) for _, a, b in found)
    monkeypatch.setattr(secret_scan, "WINDOW", 1000)
    monkeypatch.setattr(secret_scan, "STEP", 100)
    for before in ("é, line.\n" * 3000, "z" * 9001 + " ", "no end " * 3001):
        for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
            token = base64.b64encode(pack((before + "password=hunter22x").encode())).decode()
            assert _added(f"a {token} b") == [("assign", 2, 2 + len(token))]


def test_secrets_decoding_ends():
    assert secret_scan.secrets("%2525252525252541" * 50) == []
    assert secret_scan.secrets("A" * 5000) == []


def test_secrets_base_spans_against_the_plain_rule():
    import re

    rng = random.Random(8)
    bits = ["token", "SECRET", "api_key", "apikey", '"', "'", " ", ":", "=", "abc123", "x", "AKIA", "ABCDEFGHIJKLMNOP1", "0a1b2c3d" * 3, "\n", "ſecret", "password"]
    rules = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
        "access": (r"AKIA[A-Z0-9]+", 0), "hex": (r"[0-9a-f]+", 0),
    }
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        want = []
        for k, (kind, (rule, flags)) in enumerate(rules.items()):
            for m in re.finditer(rule, text, flags):
                size = len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24)
                if size:
                    want.append((m.start(), k, m.end()))
        got = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in secret_scan.secrets(text) if s["base"]]
        assert got == sorted(want)


def test_secrets_odd_rows(odd, none):
    rows = odd.select(secret_scan.find_secrets("text").alias("s")).collect()
    assert [r["s"] for r in rows] == [[]] * 10
    assert none.select(secret_scan.find_secrets("text")).count() == 0


# --- 9 pages ------------------------------------------------------------------


def test_html_keeps_the_article_only():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>'
        '<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>'
        '<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>'
        "<article><h1>Head &amp; shoulders</h1><p>First  para\n graph.<p><b>Second one<br><p>Un.</p></article>"
        '<div id="comments"><p>I disagree with all of this very much indeed, dear author.</p></div>'
        '<aside>Side</aside><form><input name="q">Search</form><footer>&copy; x</footer></body></html>'
    )
    assert html_text.main_text(page) == "Head & shoulders\nFirst para graph.\nSecond one\nUn."


def test_html_without_article_tag_and_broken_markup():
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(20))
    page = f"<body><div><ul>{links}</ul></div><div><p>{LONG[:400]}</p><p>{LONG[:300]}</p></div>"
    assert html_text.main_text(page) == f"{LONG[:400].strip()}\n{LONG[:300].strip()}"
    assert html_text.main_text("<p>a < b <i>and</i> c &lt; d <!-- x") == "a < b and c < d"
    for page, text in [(None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain  words", "plain words")]:
        assert html_text.main_text(page) == text
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"


def test_html_keeps_all_parts_of_an_article():
    def ps(n, word):
        return "".join(f"<p>{word} {k} {LONG[:200].strip()}</p>" for k in range(n))

    def lines(n, word):
        return [f"{word} {k} {LONG[:200].strip()}" for k in range(n)]

    nested = f'<h1>Head</h1><div class="entry">{ps(10, "a")}</div><p>Closing.</p>'
    links = "<ul>" + "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(20)) + "</ul>"
    for tag in ("article", "main", "div"):
        page = f"<body><div>{links}</div><{tag}>{nested}</{tag}></body>"
        assert html_text.main_text(page).split("\n") == ["Head", *lines(10, "a"), "Closing."]
        page = f"<body><{tag}><section>{ps(10, 'a')}</section><section>{ps(8, 'b')}</section></{tag}><div>{links}</div></body>"
        assert html_text.main_text(page).split("\n") == lines(10, "a") + lines(8, "b")
    page = f'<body>Text of the <b>body</b>.<a href="/">Home</a><div>{ps(9, "a")}</div><div>{links}</div>The end.</body>'
    assert html_text.main_text(page).split("\n") == ["Text of the body.Home", *lines(9, "a"), "The end."]
    page = f'<body><a href="/">Home</a> | <a href="/b">About</a><h1>Head</h1><div>{ps(9, "a")}</div></body>'
    assert html_text.main_text(page).split("\n") == ["Head", *lines(9, "a")]
    page = f"<body>\n<font>\n<article>{nested}</article>\n</font>\n<div>{links}</div>\n</body>"
    assert html_text.main_text(page).split("\n") == ["Head", *lines(10, "a"), "Closing."]
    page = f"<body>First words.<div><h1>Head</h1><div>{links}</div></div><div>{ps(9, 'a')}</div>Last words.</body>"
    assert html_text.main_text(page).split("\n") == ["First words.", "Head", *lines(9, "a"), "Last words."]


def test_html_noise_is_a_whole_attribute():
    for kept in (
        '<a href="hidden-valley.html">', '<b title="A hidden gem">', '<section data-hidden="false">', "<a href=/q?id=share-1>",
        '<a href="/q?id=share-1">', '<p data-id="comment-3">', "<p title='class=\"ad\"'>", '<p data-role = "dialog" lang=en>',
    ):
        tag = kept[1:].split()[0]
        page = f"<article><div>Some words and {kept}these ones</{tag}></div></article>"
        assert " ".join(html_text.main_text(page).split()) == "Some words and these ones", kept
    for noise in ("hidden", 'hidden=""', 'HIDDEN lang="en"', 'title="x" class=ad', "lang=en id = 'share'", 'a"b"class="ad"', "aria-hidden=true", 'style="x:y;display: none"', "/hidden"):
        assert html_text.main_text(f"<article><p>Some words</p><div {noise}>and these</div></article>") == "Some words", noise


def test_html_given_pages(spark):
    """The given pages hold one article element each; a plain cut of it must agree."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    for r in queries.op9_html_text(spark, SF001).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


# --- 10 decontamination -------------------------------------------------------


def test_decontamination_odd_rows_and_blocks(spark, odd, none):
    items = spark.createDataFrame(
        [(1, "the rain in Spain the rain in spain the rain in"), (1, "the rain in Spain the rain in spain the rain in"),
         (2, None), (3, ""), (4, "DAS und"), (None, "same text"), (5, "not there at all"), (6, "nicht")],
        "item_id long, text string",
    )
    for bound in (64 << 20, 700, 1):  # all broadcast; only keys; nothing
        got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in decontaminate.contamination(odd, items, broadcast_bytes=bound).collect()}
        assert got == {
            (1, 4, 2, 0), (2, 4, 2, 0), (None, 4, 2, 0), (3, 0, 0, 0), (4, 0, 0, 0), (None, 0, 0, 0),
            (5, 80_000, 79_999, 1), (6, 0, 0, 0), (7, 5, 3, 2),
        }
    assert decontaminate.contamination(odd, items).count() == odd.count()
    clean = decontaminate.drop_contaminated(odd, items)
    assert clean.columns == odd.columns and sorted((r["doc_id"] or 0) for r in clean.collect()) == [0, 3, 4, 6]
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).where("contaminated").count() == 0


def test_decontamination_keeps_large_documents_out_of_shuffles(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    found = decontaminate.occurrences(docs, spark.read.parquet(f"{SF0001}/benchmark.parquet"))
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_decontamination_items_that_share_windows(spark):
    """Many items with one sentence: no list of items leaves the last aggregate, and either join gives the same rows."""
    sentence = "these ten words stand at the start of every item"
    items = spark.range(3_000).select("id", F.concat(F.lit(sentence + " "), F.col("id").cast("string")).alias("text"))
    docs = spark.createDataFrame(
        [(1, f"see {sentence} 7 and"), (2, sentence + " 2999"), (3, "nothing here"), (4, (sentence + " ") * 3)], "doc_id long, text string")
    got = [sorted(map(tuple, decontaminate.contamination(docs, items, item_id="id", broadcast_bytes=b).collect())) for b in (64 << 20, 1)]
    assert got[0] == got[1]
    assert [(r[0], r[1], r[2], r[3]) for r in got[0]] == [(1, 13, 11, 3_000), (2, 11, 11, 3_000), (3, 2, 0, 0), (4, 30, 30, 3_000)]
    windows = decontaminate.occurrences(docs, items, item_id="id")
    assert dict(windows.dtypes)["window"] == "string" and windows.count() == 7


def test_decontamination_query_is_the_same_without_broadcasts(spark):
    docs, items = (queries.read_table(spark, SF0001, t) for t in ("documents", "benchmark"))
    want = decontaminate.contamination(docs, items)
    got = decontaminate.contamination(docs, items, broadcast_bytes=1)
    assert want.exceptAll(got).isEmpty() and want.count() == got.count() and want.where("contaminated").count() >= 3


# --- all ----------------------------------------------------------------------


def test_every_operator_has_its_query():
    assert {q.split("_")[0] for q in queries.REGISTRY} == {f"op{n}" for n in range(1, 14)}
    assert set(oracle.ORACLE) <= set(queries.REGISTRY)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, columns = docs.count(), docs.columns
        stage(spark, docs, SF0001).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() <= before
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    got = corpus_pipeline.run(spark, SF0001)
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_odd_rows(spark, odd, none):
    for table in (odd.drop("_id"), none):
        docs = table
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame((made := stage(spark, docs, SF0001)).collect(), made.schema)
        assert docs.columns == ["doc_id", "n_pieces", "ids", "costs"]
