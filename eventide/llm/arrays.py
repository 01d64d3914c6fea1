"""Texts of a batch as code-point arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

MAX_CHARS = 4_000_000


def slices(texts: Sequence[str], max_chars: int = MAX_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold at most ``max_chars`` characters, or one text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > max_chars:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` in a row, and where each text starts (one more at the end)."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return codes, starts


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
