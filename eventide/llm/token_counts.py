"""Token counts by trie-shared dynamic programming.

The distinct chunks of a slice of texts are put in a trie, and a unigram
forward pass runs over it: each trie node (a prefix) gets its least (cost,
number of pieces) once, from the nodes that a piece's length above it, whatever
number of chunks share the prefix.  A chunk's terminal node holds its count, and
a text's count is the sum over its chunks.  The trie is walked in the order of
the sorted chunks, so only the path to the current node is held.

Defined results: null and empty texts have the one chunk of the extra space
only and count 0 tokens; a text of any length is split and counted whole, with its
chunks held at once; of pieces with equal cost the fewer count; equal rows get equal
counts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import slices
from .pieces import COUNT_BITS, Lattice, Vocabulary, chunks, lattice

RESULT = "n_chunks long, n_tokens long"


def terminal_counts(distinct: Iterable[str], pieces: Lattice) -> dict[str, int]:
    """Number of pieces in the best segmentation of each chunk; shared prefixes are scored once."""
    counts: dict[str, int] = {}
    path = ""
    best = [0]  # least weight at each prefix of the path
    weight, ends, longest, pieces_of = pieces.weight.get, pieces.ends, pieces.longest, (1 << COUNT_BITS) - 1
    for chunk in sorted(distinct):
        shared, most = 0, min(len(path), len(chunk))
        while shared < most and path[shared] == chunk[shared]:
            shared += 1
        del best[shared + 1 :]
        for j in range(shared + 1, len(chunk) + 1):
            part = chunk[j - 1]
            least = best[-1] + (weight(part) or pieces.bytes_weight(part))
            if part in ends:
                for i in range(j - 2, max(j - longest, 0) - 1, -1):
                    part = chunk[i:j]
                    w = weight(part)
                    if w and best[i] + w < least:
                        least = best[i] + w
                    if part not in ends:
                        break
            best.append(least)
        path = chunk
        counts[chunk] = best[-1] & pieces_of
    return counts


def count_texts(texts: list[str | None], vocabulary: Vocabulary) -> pd.DataFrame:
    pieces = lattice(vocabulary)
    whole = [t or "" for t in texts]
    rows = []
    for a, b in slices(whole):
        split = [chunks(t) if t else [] for t in whole[a:b]]
        counts = terminal_counts({c for cs in split for c in cs}, pieces)
        rows += [(len(cs), sum(map(counts.__getitem__, cs))) for cs in split]
    return pd.DataFrame(rows, columns=["n_chunks", "n_tokens"])


def token_counts(text: Column | str, vocabulary: Vocabulary) -> Column:
    """Struct column ``n_chunks, n_tokens`` of the whole text of each row."""

    @F.pandas_udf(RESULT)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield count_texts(texts.tolist(), vocabulary)

    return counted(text)
