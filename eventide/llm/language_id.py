"""Language identification by cross-parsing against suffix automata.

A bounded, documented sample of labelled text per language becomes one suffix
automaton per language: whole texts, at most ``sample_docs`` of them and as many
as ``sample_chars`` characters hold (one at least), picked by the smallest hash of
the text among the rows that may be learnt from.  Texts of more than an eighth of
``sample_chars`` come last, the shorter ones first.  Walking a text through an
automaton yields the longest match from each phrase start; where no transition
exists a phrase ends and the next one starts.  The number of phrases times log2 of
the sample's length is the text's cost in bits under that language (the
normalisation: a longer sample gives longer matches but needs longer references).
The cheapest language wins; the score is its share of the summed likelihoods 2^-bits.

Only letters count: text is lower-cased and each run of other characters is one
space.  Every text is parsed whole.  All blocks of ``BLOCK`` symbols of a batch walk
the automata in step, one symbol at a time, as numpy lanes, each as if a phrase began
with it; then each block is walked again from the state in which the one before it
ended, until both walks are in the same state, and its count is set right.  So
phrases run over block borders, and ``BLOCK`` changes the time only.

The sample, not the automata, travels to the tasks: each Python worker builds
the tables once.

Defined results: ``und`` with score 0 for null text, for text without a letter,
and for every text if nothing could be learnt.  Equal costs go to the language
that sorts first; rows that repeat a text are one sample text and get equal results;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import code_points, letter_table, slices
from .common import least, packed

UNDETERMINED = "und"
BLOCK = 4096
RESULT = "lang_pred string, score double"


@dataclass(frozen=True)
class Profile:
    """Labelled sample text per language, in order of language."""

    languages: tuple[str, ...]
    samples: tuple[str, ...]


def learn(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", usable: Column | None = None,
    sample_docs: int = 64, sample_chars: int = 24_000,
) -> Profile:
    """A profile from at most ``sample_docs`` labelled texts per language."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    if usable is not None:
        rows = rows.where(usable)
    rank = F.struct(F.greatest(F.length(text_col), F.lit(sample_chars // 8)).alias("chars"), F.xxhash64(text_col).alias("h"))
    keyed = rows.select(
        F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), rank.alias("rank"), F.length(text_col).alias("n"),
        F.col(text_col).alias("text"),
    )
    picked = least(keyed.select("lang", "h", "rank", "n").distinct(), "lang", "rank", sample_docs, "h")
    upto = Window.partitionBy("lang").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    picked = picked.withColumn("upto", F.sum("n").over(upto)).where(
        (F.col("upto") <= sample_chars) | (F.col("upto") == F.col("n"))
    ).select("lang", "h")
    sample = keyed.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "h").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    names = tuple(sorted(texts))
    return Profile(names, tuple(" ".join(texts[n]) for n in names))


def identify(text: Column | str, profile: Profile) -> Column:
    """Struct column ``lang_pred, score`` of a text column."""

    @F.pandas_udf(RESULT)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield predict(texts.tolist(), profile)

    return predicted(text)


def keep_known(docs: DataFrame, profile: Profile, text_col: str = "text") -> DataFrame:
    """``docs`` without the texts whose language can not be told, columns as they were."""
    found = packed(docs, identify(text_col, profile).alias("_p"))
    return found.where(F.col("_p.lang_pred") != UNDETERMINED).select("_row.*")


def predict(texts: list[str | None], profile: Profile) -> pd.DataFrame:
    parts = [np.empty((0, len(profile.languages)))]
    letters = [np.empty(0, dtype=bool)]
    whole = [t or "" for t in texts]
    for a, b in slices(whole):
        bits, has = parse_costs(whole[a:b], profile)
        parts.append(bits)
        letters.append(has)
    bits, known = np.concatenate(parts), np.concatenate(letters)
    known &= len(profile.languages) > 0
    out = pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0})
    if known.any():
        cost = bits[known]
        best = cost.argmin(axis=1)
        ratio = np.exp2(np.maximum(cost.min(axis=1, keepdims=True) - cost, -1000))
        out.loc[known, "lang_pred"] = [profile.languages[k] for k in best]
        out.loc[known, "score"] = 1 / ratio.sum(axis=1)
    return out


def parse_costs(texts: list[str], profile: Profile) -> tuple[np.ndarray, np.ndarray]:
    """Bits per text and language, and whether the text has a letter."""
    if not profile.languages:
        return np.zeros((len(texts), 0)), np.zeros(len(texts), dtype=bool)
    machine = _machine(profile)
    symbols, starts, has = _symbols([t.lower() for t in texts], machine.classes)
    phrases = _phrases(symbols, starts, machine)
    return phrases * machine.bits, has


def _symbols(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol classes with runs of non-letters as one 0, starts of texts, and which have letters."""
    codes, starts = code_points(texts)
    symbols = classes[codes]
    gap = symbols == 0
    keep = np.ones(len(symbols), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    inner = starts[:-1][starts[:-1] < len(symbols)]
    keep[inner] = True  # a text's first symbol does not depend on the text before it
    upto = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(~gap)])
    return symbols[keep], upto[starts], letters[starts[1:]] > letters[starts[:-1]]


def _phrases(symbols: np.ndarray, starts: np.ndarray, machine: "_Machine") -> np.ndarray:
    """Phrases per text and language: all blocks walk the automata in step."""
    sizes = np.diff(starts)
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = starts[owner] + nth * BLOCK
    length = np.minimum(sizes[owner] - nth * BLOCK, BLOCK)
    order = np.argsort(-length, kind="stable")
    sorted_begin, sorted_length = begin[order], length[order]
    state = np.repeat(machine.roots[:, None], len(owner), axis=1)
    ended = np.zeros(state.shape, dtype=np.int32)
    longest = int(sorted_length[0]) if len(length) else 0
    active = len(length) - np.searchsorted(sorted_length[::-1], np.arange(longest), side="right")
    for t in range(longest):
        k = active[t]
        step = machine.table.take(state[:, :k] + symbols[sorted_begin[:k] + t])
        state[:, :k] = step >> 2
        ended[:, :k] += step & 3
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    state, ended = state[:, back], ended[:, back]
    if len(owner) and int(nth.max()) > 0:
        ended, state = _continued(symbols, begin, length, nth, state, ended, machine)
    last = np.append(owner[1:] != owner[:-1], True) if len(owner) else np.zeros(0, dtype=bool)
    total = np.zeros((len(sizes), len(machine.roots)))
    np.add.at(total, owner, ended.T)
    np.add.at(total, owner[last], (state[:, last] != machine.roots[:, None]).T)
    return total


def _continued(
    symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, nth: np.ndarray, state: np.ndarray, ended: np.ndarray,
    machine: "_Machine",
) -> tuple[np.ndarray, np.ndarray]:
    """Phrase ends and end states of blocks that go on from the block before them.

    A block's walk from the true state and that from the root meet after a few
    phrases.  A block in which they do not meet ends in another state than was assumed,
    so the next one is walked again.
    """
    ends, right = state.copy(), np.zeros_like(ended)
    again = (nth[None, 1:] > 0) & (state[:, :-1] != machine.roots[:, None])
    lang, block = np.nonzero(again)
    block = block + 1
    while len(block):
        true, assumed = ends[lang, block - 1], machine.roots[lang].copy()
        off = np.zeros(len(block), dtype=np.int32)
        before = ends[lang, block].copy()
        live, t = np.arange(len(block)), 0
        while len(live):
            at = symbols[begin[block[live]] + t]
            a, b = machine.table.take(true[live] + at), machine.table.take(assumed[live] + at)
            true[live], assumed[live] = a >> 2, b >> 2
            off[live] += (a & 3) - (b & 3)
            t += 1
            live = live[(true[live] != assumed[live]) & (t < length[block[live]])]
        met = true == assumed
        right[lang, block] = off
        ends[lang, block] = np.where(met, state[lang, block], true)
        changed = (ends[lang, block] != before) & (block + 1 < len(nth))
        lang, block = lang[changed], block[changed] + 1
        inside = nth[block] > 0
        lang, block = lang[inside], block[inside]
    return ended + right, ends


@dataclass(frozen=True)
class _Machine:
    """``table[state + symbol]`` is four times the next state, plus the phrases that end by that step.

    A symbol that the sample lacks ends the phrase before it and is one by itself.
    """

    table: np.ndarray
    roots: np.ndarray
    classes: np.ndarray
    bits: np.ndarray


@lru_cache(maxsize=4)
def _machine(profile: Profile) -> _Machine:
    letters = letter_table()
    spelled = sorted({c for s in profile.samples for c in s.lower() if c.isalpha()})
    classes = np.where(letters, len(spelled) + 1, 0).astype(np.int32)
    classes[[ord(c) for c in spelled]] = np.arange(1, len(spelled) + 1)
    width = len(spelled) + 2  # the last class: letters that no sample has
    tables, roots, bits, base = [], [], [], 0
    for sample in profile.samples:
        symbols, _, _ = _symbols([sample.lower()], classes)
        edges = suffix_automaton(symbols.tolist())
        grid = np.full((len(edges), width), -1, dtype=np.int64)
        for s, out in enumerate(edges):
            for c, to in out.items():
                grid[s, c] = to
        missing = grid < 0
        ended = np.where(missing, 1 + (grid[0] < 0), 0)
        ended[0] = missing[0]
        to = np.where(missing, np.maximum(grid[0], 0), grid) * width + base
        tables.append((to * 4 + ended).astype(np.int32).ravel())
        roots.append(base)
        bits.append(np.log2(max(len(symbols), 2)))
        base += grid.size
    return _Machine(np.concatenate(tables), np.array(roots, dtype=np.int32), classes, np.array(bits))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in symbols:
        new = len(edges)
        edges.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return edges
