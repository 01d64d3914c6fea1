"""A piece vocabulary read from a public SentencePiece file, as a unigram model.

The file is a parameter.  Nothing is trained: a piece's cost follows from its
rank in the file by Zipf's law, ``ln(rank) + ln(harmonic number)``, in whole
millionths so that sums are exact in any order.  A character that no piece
covers is spelled by its UTF-8 bytes, each as dear as the rarest piece plus 10.

Text starts with one extra space, as the file's own tool has it, and a piece's
``▁`` stands for a space; the character ``▁`` itself is spelled in bytes, so
decoding gives back exactly the text.  No piece goes from a non-space to a space
and none holds a line break, so a text falls into chunks (``CHUNK``) that can be
segmented one by one.  A chunk's best segmentation has the least (cost, number
of pieces), and among these the longest last piece.

The driver reads the file; tasks get the pieces with the job.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
MILLION = 1_000_000
COUNT_BITS = 32
ANY_CODE = "surrogatepass"


@dataclass(frozen=True, eq=False)
class Vocabulary:
    """Pieces by id as in the file, and what each costs; ids of the 256 byte pieces in order.

    Two are equal if their digests are: the lookups built from a vocabulary are
    kept by it, and hashing all its pieces each time would cost more than the work.
    """

    pieces: tuple[str, ...]
    costs: tuple[int, ...]  # -1: not to be used in a segmentation
    byte_ids: tuple[int, ...]
    digest: bytes = field(init=False)

    def __post_init__(self) -> None:
        content = repr((self.pieces, self.costs, self.byte_ids)).encode()
        object.__setattr__(self, "digest", hashlib.sha256(content).digest())

    def __hash__(self) -> int:
        return hash(self.digest)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Vocabulary) and self.digest == other.digest


def load(path: str = MODEL_PATH) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = tuple(model.id_to_piece(i) for i in range(size))
    plain = [
        i for i in range(size)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    if any(re.search("[^▁]▁|\n", pieces[i]) for i in plain):
        raise ValueError("a piece goes across chunks")
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the file has no byte pieces")
    total = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    costs = [-1] * size
    for rank, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i)), 1):
        costs[i] = round((math.log(rank) + total) * MILLION)
    for i in byte_ids:
        costs[i] = round((math.log(len(plain)) + total + 10) * MILLION)
    return Vocabulary(pieces, tuple(costs), byte_ids)


@dataclass(frozen=True)
class Lattice:
    """Lookups for segmentation.

    A weight is a cost and a number of pieces in one integer, ``cost << COUNT_BITS | pieces``,
    so that sums and comparisons of weights are those of the pairs.
    """

    weight: dict[str, int]
    id_of: dict[str, int]
    ends: frozenset[str]  # endings of longer pieces
    byte_weight: int
    byte_ids: tuple[int, ...]
    longest: int
    spelled: tuple[bytes, ...]  # bytes of each id

    def bytes_weight(self, char: str) -> int:
        return len(char.encode("utf-8", "surrogatepass")) * self.byte_weight

    def ids(self, part: str) -> tuple[int, ...]:
        """The id of a piece, or those of a character's bytes."""
        known = self.id_of.get(part)
        return (known,) if known is not None else tuple(self.byte_ids[b] for b in part.encode("utf-8", "surrogatepass"))

    def edges(self, text: str, j: int) -> list[tuple[int, int]]:
        """What may end before place ``j``: (start, weight)."""
        found = []
        for i in range(j - 1, max(j - self.longest, 0) - 1, -1):
            part = text[i:j]
            w = self.weight.get(part)
            if w:
                found.append((i, w))
            elif i == j - 1:
                found.append((i, self.bytes_weight(part)))
            if part not in self.ends:
                break
        return found


@lru_cache(maxsize=2)
def lattice(vocabulary: Vocabulary) -> Lattice:
    special = set(vocabulary.byte_ids)
    usable = {
        p.replace("▁", " "): (c, i)
        for i, (p, c) in enumerate(zip(vocabulary.pieces, vocabulary.costs))
        if c >= 0 and i not in special
    }
    spelled = [p.replace("▁", " ").encode() if c >= 0 else b"" for p, c in zip(vocabulary.pieces, vocabulary.costs)]
    for b, i in enumerate(vocabulary.byte_ids):
        spelled[i] = bytes([b])
    return Lattice(
        {p: c << COUNT_BITS | 1 for p, (c, _) in usable.items()},
        {p: i for p, (_, i) in usable.items()},
        frozenset(p[k:] for p in usable for k in range(1, len(p))),
        vocabulary.costs[vocabulary.byte_ids[0]] << COUNT_BITS | 1,
        vocabulary.byte_ids,
        max(map(len, usable)),
        tuple(spelled),
    )


def chunks(text: str) -> list[str]:
    """The chunks of a text after its extra space; they join to ``" " + text``."""
    return CHUNK.findall(" " + text)


def chunk_places(texts: Sequence[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of ``texts`` in bytes, each occurrence's place among them, and where a text's occurrences begin.

    The same chunks as ``chunks`` gives, none for an empty text; begins have one more at the end.
    """
    raw = [f" {t}".encode("utf-8", ANY_CODE) if t else b"" for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    text_at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    space, line = data == 0x20, data == 0x0A
    opens = line.copy()
    opens[1:] |= np.where(space[1:], ~space[:-1], line[:-1])
    opens[text_at[:-1][np.diff(text_at) > 0]] = True
    at = np.flatnonzero(opens)
    bounds = np.append(at, len(data)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    coded = found.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(at, text_at)


def chunk_texts(distinct: pa.Array) -> list[str]:
    return [c.decode("utf-8", ANY_CODE) for c in distinct.to_pylist()]
