"""Periodic runs of words by seed and extend on diagonals.

A run of period ``q`` and at least ``max(6, 4q)`` words agrees with itself,
moved by ``q`` words, over at least ``max(6, 4q) - q`` places.  So lags are
taken in classes (1; 2 and 3; 4 to 7; ...) and each class indexes the k-grams
of its least guaranteed overlap: 5 words for lag 1, and ``3 * 2**m`` for the
lags from ``2**m`` to ``2**(m + 1) - 1``.

* Index: a gram's name is the pair of the names of its two halves, so the next
  class names its grams from those of the last, and only grams that occur twice
  are kept.  Most texts have none left after two classes.
* Seeds: two neighbouring occurrences of a gram in one document whose distance
  is a lag of the class.  Neighbours suffice: a gram is over one and a half
  times as long as each lag of its class, so another occurrence between would
  give the run a smaller period.
* Extension: a seed is a place on the diagonal of its lag and is extended both
  ways, word by word, as far as the text agrees with itself.  Seeds of a lag come
  in order, and those before the furthest place that the lag has covered are
  skipped, so no stretch of a diagonal is walked twice.

A stretch that is long enough is a run, and its lag is its smallest period, for
the same reason that neighbours suffice.

Defined results: null, empty and blank texts have no words and no runs; texts
of any length are worked on whole; equal rows get equal results; of runs with
equal exponents the one that starts first, then that of the smaller period, is
the strongest; an empty table gives no rows.  One text is one value and is
worked on by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import slices

RESULT = (
    "n_words long, starts array<long>, lengths array<long>, periods array<long>, "
    "strongest long, collapsed string"
)
MIN_WORDS, MIN_TURNS = 6, 4

#: Fixed value of the word rule: what separates words, as a regular expression of Spark's ``split``.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def split_words(text: str | None) -> list[bytes]:
    """Stretches without the six ASCII white-space characters, in UTF-8 (whose split knows just these)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _paired(first: np.ndarray, second: np.ndarray, gap: int) -> np.ndarray:
    """Names of the grams made of ``first`` here and ``second`` ``gap`` words on; -1 where it does not occur twice."""
    out = np.full(len(first), -1, dtype=np.int64)
    if gap >= len(first):
        return out
    at = np.flatnonzero((first[:-gap] >= 0) & (second[gap:] >= 0))
    if len(at):
        pairs = first[at] * (second.max() + 1) + second[at + gap]
        _, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        twice = counts[names] > 1
        out[at[twice]] = names[twice]
    return out


def _seeds(grams: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags, by lag and place, of neighbouring occurrences of a gram at a lag from ``least`` to ``most``."""
    at = np.flatnonzero(grams >= 0)
    at = at[np.argsort(grams[at], kind="stable")]
    here, there = at[:-1], at[1:]
    lag = there - here
    good = (grams[here] == grams[there]) & (lag >= least) & (lag <= most)
    here, lag = here[good], lag[good]
    order = np.lexsort((here, lag))
    return here[order], lag[order]


def _agreeing(words: np.ndarray, start: int, lag: int, step: int) -> int:
    """How many places from ``start`` on, in the direction of ``step``, agree with the place ``lag`` words on."""
    room = len(words) - lag - start if step > 0 else start + 1
    count, size = 0, 64
    while count < room:
        size = min(size, room - count)
        a = start + step * count
        if step > 0:
            same = words[a : a + size] == words[a + lag : a + lag + size]
        else:
            same = (words[a - size + 1 : a + 1] == words[a - size + 1 + lag : a + 1 + lag])[::-1]
        if not same.all():
            return count + int(np.argmin(same))
        count += size
        size *= 4
    return count


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run in an array of word names."""
    found: list[tuple[int, int, int]] = []
    _, names, counts = np.unique(words, return_inverse=True, return_counts=True)
    one = np.where(counts[names] > 1, names, -1)
    two = _paired(one, one, 1)
    three = _paired(two, one, 2)
    grams, length = _paired(three, two, 3), 5
    least, most = 1, 1
    while True:
        here, lags = _seeds(grams, least, most)
        k = 0
        while k < len(here):
            lag, at = int(lags[k]), int(here[k])
            first = at - (_agreeing(words, at - 1, lag, -1) if at else 0)
            covered = at + length
            covered += _agreeing(words, covered, lag, 1) if covered + lag < len(words) else 0
            total = covered - first + lag
            if total >= max(MIN_WORDS, MIN_TURNS * lag):
                found.append((first, total, lag))
            end = np.searchsorted(lags, lag, side="right")
            k += int(np.searchsorted(here[k:end], covered))
        if most == 1:
            grams, length = _paired(three, three, 3), 6
        else:
            grams, length = _paired(grams, grams, length), 2 * length
        least, most = most + 1, 2 * most + 1
        if not (grams >= 0).any():
            return sorted(found, key=lambda run: (run[0], run[2]))


def _strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Index of the run of the greatest exact exponent; of equal ones the first of the list."""
    best = None
    for k, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = k
    return best


def _worked(texts: list[str | None]) -> Iterator[tuple]:
    split = [split_words(t) for t in texts]
    flat = [w for words in split for w in words]
    names = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64) if flat else np.zeros(0, dtype=np.int64)
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    # Names of words are made different between texts, so no gram or run leaves its text.
    names = np.repeat(np.arange(len(split)), sizes) * (names.max(initial=0) + 1) + names
    ends = np.cumsum(sizes)
    runs = find_runs(names)
    k = 0
    for words, end in zip(split, ends.tolist()):
        base = end - len(words)
        mine = []
        while k < len(runs) and runs[k][0] < end:
            mine.append((runs[k][0] - base, *runs[k][1:]))
            k += 1
        kept = words
        if mine:
            stays = np.ones(len(words), dtype=bool)
            for start, length, period in mine:
                stays[start + period : start + length] = False
            kept = [words[i] for i in np.flatnonzero(stays)]
        yield (
            len(words), [r[0] for r in mine], [r[1] for r in mine], [r[2] for r in mine], _strongest(mine),
            b" ".join(kept).decode("utf-8", "surrogatepass"),
        )


def run_texts(texts: list[str | None]) -> pd.DataFrame:
    rows = [
        row for a, b in slices([t or "" for t in texts]) for row in _worked(texts[a:b])
    ]
    frame = pd.DataFrame(rows, columns=["n_words", "starts", "lengths", "periods", "strongest", "collapsed"])
    return frame.astype({"strongest": "Int64"})


def periodic_runs(text: Column | str) -> Column:
    """Struct column of each whole text's runs.

    ``n_words``; ``starts``, ``lengths`` and ``periods`` of the runs by start,
    then period; ``strongest``, the place in these of the run of the greatest
    length / period, or null; ``collapsed``, the words with each run cut to its
    first period, joined by spaces.
    """

    @F.pandas_udf(RESULT)
    def runs(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield run_texts(texts.tolist())

    return runs(text)
