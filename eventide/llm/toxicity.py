"""Toxicity scores after noisy-channel deobfuscation.

A writer's plain word is seen through a channel that swaps letters for digits
and signs, spaces a word out, or repeats letters, in any mixture.  Each
suspicious span of a text (letters with signs before, in or after them; three
or more symbols or short groups set apart; unusual doubled and all tripled
letters) is turned into a lattice of what its characters may stand for: a sign
for a letter, nothing or itself; a separator for nothing or the end of a word, which
costs what the character model asks for a word's edge; a doubled letter for one or
two.  A Viterbi search under a character trigram model finds the likeliest plain
spelling, which may be the one written.  The trigram counts come from all documents (``count_trigrams``, a
distributed sum), mixed with the words of the learned lexicon.

The restored text is scored by rules over the words it holds.  A rule is a word
or a word's start; it has one weight for texts where a single distinct word
obeys it and one for texts with several, each a lower confidence bound of the
log odds among labelled texts.  Rules are learnt by sequential covering: the
heaviest is taken, the words it explains leave the pool, and what is left is
weighed again, so that "lose" does not inherit what "loser" explains.  A text's
evidence is its largest weight and a small share of the next ones, so many weak
chance rules do not add up to a strong one; a logistic curve, fitted with each
training text left out of its own weights, maps it to 0..1.

The classifier is fitted on a bounded sample: at most ``per_class`` labelled
texts of each class, those with the smallest text hashes.  Class sizes are
counted over all labelled rows.  Scoring reads every whole text.

Defined results: null and empty texts have no evidence and get the curve's
value at 0 (below one half); of equally likely spellings the one found first
counts, in the order of the options; rows that repeat a text are one training text
and get equal scores; an empty table gives no rows; without a labelled toxic and a labelled clean text
every score is 0.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import code_points, letter_table, slices
from .common import least, row_key

#: The letters that a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
SIGNS = "".join(re.escape(c) for c in STANDS_FOR)
SYMBOL = f"[a-z{SIGNS}]"
NOT_BEFORE = rf"(?<![\w{re.escape('@$!|+')}])"
#: An exclamation mark or a bar behind a word is punctuation, not a part of it.
SWAPPED = re.compile(rf"{NOT_BEFORE}(?=[a-z]*[{SIGNS}])(?=[{SIGNS}]*[a-z]){SYMBOL}*[a-z0-9@$+]")
SPACED = re.compile(
    rf"{NOT_BEFORE}{SYMBOL}(?:[ .*_-]{{1,2}}{SYMBOL}){{2,}}(?![\w@$+])|"
    rf"{NOT_BEFORE}(?:[a-z]{{1,3}}|{SYMBOL})(?:[.*_-]{{1,2}}(?:[a-z]{{1,2}}|{SYMBOL})){{2,}}(?![\w@$+])"
)
#: Fixed value: letters that are hardly ever doubled within a word; at its start, none but l is.
RARELY_DOUBLED = "ahijkquvwxy"
REPEATED = re.compile(
    rf"(?<![^\W\d_])([a-km-z])\1[a-z]+|(?<![a-z])[a-z]*?(?:([a-z])\2\2|([{RARELY_DOUBLED}])\3)[a-z]*"
)
ANY_SIGN = re.compile(f"[{SIGNS}]")
SINGLE = re.compile(rf"(?<![a-z{SIGNS}]){SYMBOL}(?![a-z{SIGNS}])")
WORD = re.compile(r"[^\W\d_]+")

#: Costs (natural log) of what the channel did.
SWAP, DROP, DOUBLE, KEEP = 0.5, 0.1, 1.5, 2.0
HALVE = 3.0  # a doubled letter is mostly meant
SYMBOLS = 28  # edge of a word, a-z, any other letter
STARTS = range(3, 9)  # lengths of word starts that are features
TOP = 3
FURTHER = 0.1  # share of the weights after the largest
CAUTION = 2.0  # standard errors below the log odds


@dataclass(frozen=True)
class Model:
    trigrams: bytes  # float32 log probabilities, SYMBOLS ** 3
    rules: tuple[tuple[str, float, float], ...]  # in order of precedence: start or =word, weight of one, of several
    intercept: float
    slope: float


# --- the character model -------------------------------------------------


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


@lru_cache(maxsize=1)
def _symbol_table() -> np.ndarray:
    table = np.where(letter_table(), 27, 0).astype(np.int32)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    return table


def _trigram_counts(texts: Iterable[str]) -> np.ndarray:
    """Counts of symbol triples; words are padded by their edges, texts do not touch."""
    codes, _ = code_points([f"  {t}  " for t in texts])
    s = _symbol_table()[codes]
    triple = (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]
    # a triple that runs over an edge between two words says nothing about spelling
    inside = ~((s[1:-1] == 0) & ((s[:-2] != 0) | (s[2:] == 0)))
    return np.bincount(triple[inside], minlength=SYMBOLS**3)


def count_trigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``triple, n`` over the whole texts of all rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in slices(texts):
                total += _trigram_counts(texts[a:b])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["triple", "n"])

    return (
        docs.select(text_col).mapInArrow(counted, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    )


def _log_probabilities(counts: np.ndarray, lexicon: Iterable[str]) -> np.ndarray:
    """Trigram model of the corpus, mixed half and half with that of the lexicon's words."""

    def smoothed(c: np.ndarray) -> np.ndarray:
        c = c.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        two = c.sum(axis=0) + 0.1
        back = two / two.sum(axis=1, keepdims=True)
        return (c + 5 * back[None]) / (c.sum(axis=2, keepdims=True) + 5)

    words = list(lexicon)
    return np.log(0.5 * smoothed(counts) + 0.5 * smoothed(_trigram_counts(words) if words else counts)).astype(np.float32)


# --- the channel ----------------------------------------------------------


def _options(span: str) -> list[list[tuple[str, float]]]:
    """For each place of the lattice, the plain spellings and their channel costs.

    A spelling that is no letter ends a word.
    """
    places: list[list[tuple[str, float]]] = []
    for run in re.finditer(r"(.)\1*", span, re.S):
        c, n = run[1], len(run[0])
        if c.isalpha():
            places.append([(c, 0.0)] if n == 1 else [(c + c, 0.0), (c, HALVE)] if n == 2 else [(c, 0.0), (c + c, DOUBLE)])
        elif c in STANDS_FOR:
            places += [[(x, SWAP) for x in STANDS_FOR[c]] + [("", SWAP + 4.0), (c, KEEP)]] * n
        else:
            places.append([("", DROP), (" ", 0.0)])
    return places


def decode(span: str, logp: np.ndarray) -> str:
    """The likeliest plain spelling of a suspicious span."""
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in _options(span):
        ahead: dict[tuple[int, int], tuple[float, tuple]] = {}
        for state, (score, spelled) in paths.items():
            for letters, cost in options:
                (a, b), s, path = state, score - cost, spelled
                for x in letters:
                    c = _symbol(x)
                    if c:
                        s += float(logp[a, b, c])
                        a, b = b, c
                    else:  # a word ends, and the next one begins as at the start of a text
                        s += float(logp[a, b, 0]) if b else 0.0
                        a = b = 0
                    path = (path, x)
                if (a, b) not in ahead or ahead[a, b][0] < s:
                    ahead[a, b] = (s, path)
        paths = ahead
    _, path = max(((s + (float(logp[a, b, 0]) if b else 0.0), p) for (a, b), (s, p) in paths.items()), key=lambda x: x[0])
    out = []
    while path:
        path, x = path
        out.append(x)
    return "".join(reversed(out))


@lru_cache(maxsize=2)
def _tables(model: Model):
    logp = np.frombuffer(model.trigrams, dtype=np.float32).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    plain = lru_cache(maxsize=50_000)(lambda span: decode(span, logp))
    place = {f: k for k, (f, _, _) in enumerate(model.rules)}
    rule_of = lru_cache(maxsize=500_000)(
        lambda word: min((place[f] for f in features(word) if f in place), default=None)
    )
    return plain, rule_of


SPACED_SPAN, SWAPPED_SPAN, REPEATED_SPAN = 1, 2, 4


def span_kinds(texts: list[str]) -> np.ndarray:
    """Which kinds of spans to decode each text can hold: a cheap test on symbol arrays."""
    codes, starts = code_points([t + "\n\n\n" for t in texts])
    letter = _symbol_table()[codes] > 0
    sign = _members("".join(STANDS_FOR))[codes]
    behind = sign & ~_members("!|")[codes]
    symbol = letter | sign

    swapped = np.zeros(len(codes), dtype=bool)
    swapped[:-1] |= sign[:-1] & letter[1:] | letter[:-1] & behind[1:]
    swapped[:-2] |= letter[:-2] & sign[1:-1] & symbol[2:]

    twice = np.zeros(len(codes), dtype=bool)
    twice[:-1] = letter[:-1] & (codes[:-1] == codes[1:])
    begins = letter & (codes != ord("l"))
    begins[1:] &= ~letter[:-1]
    repeated = twice & (_members(RARELY_DOUBLED)[codes] | begins)
    repeated[:-1] |= twice[:-1] & twice[1:]

    alone = symbol.copy()
    alone[1:] &= ~symbol[:-1]
    alone[:-1] &= ~symbol[1:]
    spaced = np.zeros(len(codes), dtype=bool)
    spaced[:-3] |= alone[:-3] & (alone[2:-1] | alone[3:])

    kinds = np.zeros(len(texts), dtype=np.int8)
    for kind, marked in ((SPACED_SPAN, spaced), (SWAPPED_SPAN, swapped), (REPEATED_SPAN, repeated)):
        upto = np.concatenate([[0], np.cumsum(marked)])
        kinds += kind * (upto[starts[1:]] > upto[starts[:-1]]).astype(np.int8)
    return kinds


@lru_cache(maxsize=8)
def _members(chars: str) -> np.ndarray:
    """For each code point, whether it is one of ``chars``."""
    table = np.zeros(0x110000, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


def suspicious(texts: list[str]) -> np.ndarray:
    """Which texts can hold a span to decode."""
    return span_kinds(texts) > 0


def restore(text: str, plain, kinds: int = SPACED_SPAN | SWAPPED_SPAN | REPEATED_SPAN) -> str:
    """``text`` (in lower case) with each suspicious span of the ``kinds`` it can hold replaced by its plain spelling."""

    def spaced(m: re.Match) -> str:
        span = m[0]
        # Two letters at least, and more than one symbol on its own: no list of numbers, no hyphened word.
        known = sum(c.isalpha() for c in span) >= 2 and len(SINGLE.findall(span)) >= 2
        return plain(span) if known else span

    def swapped(m: re.Match) -> str:
        span = m[0]
        return plain(span) if ANY_SIGN.search(span) else span

    if kinds & SPACED_SPAN:
        text = SPACED.sub(spaced, text)
    if kinds & SWAPPED_SPAN:
        text = SWAPPED.sub(swapped, text)
    if kinds & REPEATED_SPAN:
        text = REPEATED.sub(lambda m: plain(m[0]), text)
    return text


# --- the classifier -------------------------------------------------------


def features(word: str) -> list[str]:
    return ["=" + word] + [word[:k] for k in STARTS if k <= len(word)]


def words_of(texts: list[str | None], plain) -> Iterator[set[str]]:
    lower = [(t or "").lower() for t in texts]
    for a, b in slices(lower):
        for text, kinds in zip(lower[a:b], span_kinds(lower[a:b]).tolist()):
            yield set(WORD.findall(restore(text, plain, kinds) if kinds else text))


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = 2500, max_rules: int = 2000,
) -> Model:
    """Character model over all ``docs``; classifier on a bounded sample of labelled ``usable`` rows."""
    counts = np.zeros(SYMBOLS**3)
    for row in count_trigrams(docs, text_col).collect():
        counts[row["triple"]] = row["n"]
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("y"))
    keys = docs.where(usable & F.col(text_col).isNotNull()).select(*row_key(id_col, text_col))
    train = keys.join(marks, "_id").select("_h", "y").distinct()
    sizes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(_log_probabilities(counts, []).tobytes(), (), -math.inf, 0.0)
    picked = least(train, "y", "_h", per_class, "_h")
    sample = (
        docs.select(F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("text"))
        .join(F.broadcast(picked.select("_h", "y")), "_h")
    )
    rough = Model(_log_probabilities(counts, []).tobytes(), (), 0.0, 0.0)

    def restored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain, _ = _tables(rough)
        for batch in batches:
            words = [" ".join(sorted(w)) for w in words_of(batch["text"].tolist(), plain)]
            yield pd.DataFrame({"_h": batch["_h"], "y": batch["y"], "words": words})

    # copies of a text count once
    rows = sample.mapInPandas(restored, "_h long, y int, words string").groupBy("_h", "y").agg(F.min("words").alias("words"))
    data = [(r["y"], r["words"].split()) for r in rows.collect()]
    return fit(data, sizes, counts, max_rules)


def fit(data: list[tuple[int, list[str]]], sizes: dict[int, int], counts: np.ndarray, max_rules: int) -> Model:
    n = [max(1, sum(1 for y, _ in data if y == k)) for k in (0, 1)]

    def weight(toxic: int, clean: int) -> float:
        a, b = toxic + 0.5, clean + 0.5
        return math.log(a / (n[1] + 1)) - math.log(b / (n[0] + 1)) - CAUTION * math.sqrt(1 / a + 1 / b)

    rules = _cover(data, weight, max_rules)
    place = {f: k for k, (f, _) in enumerate(rules)}
    evidence = []
    for y, words in data:  # a text does not vouch for its own words
        held = Counter(min((place[f] for f in features(w) if f in place), default=None) for w in words)
        held.pop(None, None)
        left_out = [weight(t[_at(c)] - y, t[_at(c) + 1] - 1 + y) for k, c in held.items() for t in [rules[k][1]]]
        evidence.append(_evidence(left_out))
    x, y = np.array(evidence), np.array([k for k, _ in data], dtype=float)
    # rows stand for all labelled rows of their class
    share = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    intercept, slope = _logistic(x, y, share / share.sum() * len(y))
    weighed = tuple((f, weight(*t[:2]), weight(*t[2:])) for f, t in rules)
    lexicon = [f[1:] for f, one, _ in weighed if f[0] == "=" and one > 1]
    return Model(_log_probabilities(counts, lexicon).tobytes(), weighed, intercept, slope)


def _at(c: int) -> int:
    """Where a rule's (toxic, clean) counts stand for ``c`` distinct words: one, or several."""
    return 0 if c == 1 else 2


def _evidence(weights: Iterable[float]) -> float:
    top = sorted((w for w in weights if w > 0), reverse=True)[:TOP]
    return top[0] + FURTHER * sum(top[1:]) if top else 0.0


def _cover(data, weight, max_rules: int, least: int = 5, lightest: float = 1.0):
    """Rules in order of precedence, each with texts (toxic, clean) that have one and several words of it."""
    holders: dict[str, list[int]] = {}
    for k, (_, words) in enumerate(data):
        for w in words:
            holders.setdefault(w, []).append(k)
    toxic = Counter()
    for y, words in data:
        if y:
            toxic.update({f for w in words for f in features(w)})
    pool: dict[str, set[str]] = {f: set() for f, a in toxic.items() if a >= least}
    for w in holders:
        for f in features(w):
            if f in pool:
                pool[f].add(w)

    def tally(f: str) -> tuple[int, int, int, int]:
        held = Counter(k for w in pool[f] for k in holders[w])
        out = [0, 0, 0, 0]
        for k, c in held.items():
            out[_at(c) + 1 - data[k][0]] += 1
        return tuple(out)

    def entry(f: str):
        t = tally(f)
        best = max(weight(*t[:2]), weight(*t[2:]), weight(t[0] + t[2], t[1] + t[3]))
        return (-best, -len(f), f, len(pool[f]), t)

    heap = [entry(f) for f in pool]
    heapq.heapify(heap)
    rules: list[tuple[str, tuple[int, int, int, int]]] = []
    while heap and len(rules) < max_rules:
        best, _, f, words, t = heapq.heappop(heap)
        if not pool[f]:
            continue
        if words != len(pool[f]):  # weighed before another rule explained some of its words
            heapq.heappush(heap, entry(f))
        elif best > -lightest:
            break
        else:
            rules.append((f, t))
            for w in list(pool[f]):
                for g in features(w):
                    if g in pool:
                        pool[g].discard(w)
    return rules


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one variable by Newton steps, with a small ridge."""
    design = np.stack([np.ones_like(x), x], axis=1)
    beta = np.array([-2.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (share * (y - p)) - 0.01 * beta
        hessian = (design * (share * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def score_texts(texts: list[str | None], model: Model) -> list[float]:
    plain, rule_of = _tables(model)
    out = []
    for words in words_of(texts, plain):
        held = Counter(map(rule_of, words))
        held.pop(None, None)
        found = _evidence(model.rules[k][1 if c == 1 else 2] for k, c in held.items())
        z = model.intercept + model.slope * found
        out.append(1 / (1 + math.exp(-max(z, -700))) if z > -math.inf else 0.0)
    return out


def score(text: Column | str, model: Model) -> Column:
    """Double column: how likely the whole text is toxic, 0 to 1."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(texts.tolist(), model), dtype=float)

    return scored(text)
