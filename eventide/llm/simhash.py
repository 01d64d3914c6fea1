"""SimHash near-duplicates, compared in bit-sliced blocks.

A text's words (ASCII-lower-cased, split on white space) give its shingles; a
fingerprint bit is set if it is set in over half of the shingles' hashes.
Distinct fingerprints within ``radius`` differing bits are linked.

Candidates: the 64 bits are cut into ``radius + 2`` bands, so two fingerprints
within the radius agree on two whole bands at least; each pair of bands is one
table, keyed by the bits of both.  Rows of a table with one key are compared.

Comparison: fingerprints of a block are transposed to bit planes, 64 of them in
a machine word; a query's differences are added plane by plane with carry-save
counters that overflow exactly beyond the radius, and a block is abandoned as
soon as every lane has overflowed.  A task never emits the pairs of a group: it
joins what it links into stars, so a key with m fingerprints gives fewer than m
links, and the links of all tables go through connected components.

Only fingerprints (8 bytes) take part in the search; copies and texts with the
same fingerprint are one row there, whatever their number.  A key of more than
``BLOCK_PRINTS`` distinct fingerprints is dealt into blocks, and each pair of
blocks is a cell of its own, so no task compares more than two blocks of a key.

Defined results: null text has no words; texts without words have fingerprint
zero and link like any other; texts of any length are read whole; rows with one
text have one fingerprint; a null id is never the smallest unless a component
has no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, packed, row_key, same_key
from .components import connected_components

SEED = 42
LANES = 64
QUERIES = 256  # fingerprints compared with a block at once
CANDIDATES = 16_384  # fingerprints in a block
COUNTED = 65_536  # hashes whose bits are counted at once

_digest = partial(xxhash.xxh64_digest, seed=SEED)


# --- fingerprints ---------------------------------------------------------


def fingerprint(text: str | None, words: int = 3) -> int:
    """64-bit SimHash of a whole text, unsigned."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules for both
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[k:] for k in range(words))))
    bits = np.frombuffer(b"".join(map(_digest, shingles)), dtype=np.uint8).reshape(-1, 8)
    set_in = np.zeros(64, dtype=np.int64)
    for a in range(0, len(bits), COUNTED):
        set_in += np.unpackbits(bits[a : a + COUNTED], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_in * 2 > len(bits)).tobytes(), "big")


def fingerprints(text: Column | str, words: int = 3) -> Column:
    """Long column: the fingerprint's bits as a signed number."""

    @F.pandas_udf("long")
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = np.fromiter((fingerprint(t, words) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(prints.view(np.int64))

    return computed(text)


def as_hex(print_col: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(print_col), 16, "0"))


# --- bit-sliced comparison ------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 planes of packed lanes: bit j of plane b says whether print j has bit b."""
    padded = np.zeros(-(-len(prints) // LANES) * LANES, dtype=np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray | None:
    """Packed mask (query, word) of lanes within ``radius``; None if the block was abandoned."""
    digits = max(1, radius.bit_length())
    start = (1 << digits) - 1 - radius  # a counter then overflows at radius + 1
    shape = (len(queries), planes.shape[1])
    full = ~np.uint64(0)
    count = [np.full(shape, full if start >> d & 1 else 0, dtype=np.uint64) for d in range(digits)]
    over = np.zeros(shape, dtype=np.uint64)
    for b in range(64):
        flip = np.where(queries >> np.uint64(b) & np.uint64(1), full, np.uint64(0))
        carry = planes[b][None, :] ^ flip[:, None]
        for d in range(digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        over |= carry
        if b % 8 == 7 and (over == full).all():
            return None
    return ~over


def link(prints: np.ndarray, radius: int, others: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, centre) that join all of ``prints`` within the radius of each other.

    With ``others``, only the first ``others`` prints are compared with the rest.
    """
    root = np.arange(len(prints))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a in range(others, len(prints), CANDIDATES):
        planes = bit_planes(prints[a : a + CANDIDATES])
        size = min(CANDIDATES, len(prints) - a)
        last = others or a + size
        for q in range(0, last, QUERIES):
            mask = near(prints[q : min(q + QUERIES, last)], planes, radius)
            if mask is None:
                continue
            hits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :size]
            for i in np.flatnonzero(hits.sum(axis=1)):
                own = find(q + int(i))
                for j in np.unique(root[a + np.flatnonzero(hits[i])]):
                    other = find(int(j))
                    if other != own:
                        low, own = min(own, other), max(own, other)
                        root[own] = low
                        own = low
    centre = np.array([find(i) for i in range(len(prints))], dtype=np.int64)
    member = np.flatnonzero(centre != np.arange(len(prints)))
    return prints[member], prints[centre[member]]


def _links(radius: int):
    """Links within the cells of a sorted partition, many small ones to a block."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            part = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            if not len(part):
                continue
            if held and (part[-1, :CELL] == held[0][0, :CELL]).all():
                held.append(part)  # one cell so far
                continue
            rows = np.concatenate([*held, part])
            same = (rows[1:, :CELL] == rows[:-1, :CELL]).all(axis=1)
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            held = [rows[last:]]
            if last:
                yield from _emit(rows[:last], same[: last - 1], radius)
        if held:
            rows = np.concatenate(held)
            yield from _emit(rows, np.ones(len(rows) - 1, dtype=bool), radius)

    return linked


def _emit(rows: np.ndarray, same: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Compares the prints of each cell (``same``: a row is of the cell of the row before); short ones share a block."""
    side, prints = rows[:, CELL], np.ascontiguousarray(rows[:, CELL + 1]).view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.concatenate([starts, [len(prints)]]))
    block: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if block:
            found.append(link(np.unique(np.concatenate(block)), radius))
            block.clear()

    for k in np.flatnonzero(sizes > 1):
        run = prints[starts[k] : starts[k] + sizes[k]]
        first = int((side[starts[k] : starts[k] + sizes[k]] == 0).sum())  # a cell's sides come in order
        if first < len(run):
            if first:
                found.append(link(run, radius, first))
        elif len(run) >= QUERIES:
            found.append(link(run, radius))
        else:
            block.append(run)
            if sum(map(len, block)) >= QUERIES:
                flush()
    flush()
    for a, b in found:
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


#: Columns that tell a cell: table, key and the two blocks of its prints.
CELL = 4
#: Prints of one key that one block holds.
BLOCK_PRINTS = 20_000


def cells(prints: DataFrame, radius: int = 3, block_prints: int = BLOCK_PRINTS) -> DataFrame:
    """``t, key, i, j, side, fp``: the prints (long column ``fp``) of each cell, in which all pairs are compared.

    A key of a table of band pairs is one cell.  A key with more than ``block_prints``
    prints is dealt into blocks by hash, and each pair of blocks is a cell of its own, with
    the first block's prints on side 0 and the second's on side 1 (a block with itself:
    all on side 0).  So a hot key is many tasks' work, and each pair of prints still meets.
    """
    masks = band_masks(radius)
    rows = prints.select(
        "fp",
        F.explode(
            F.array(*[
                F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)
            ])
        ).alias("k"),
    ).select("k.t", "k.key", "fp")
    hot = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_prints).select(
        "t", "key", F.ceil(F.col("n") / block_prints).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    dealt = rows.join(hot, ["t", "key"], "left").select(
        "t", "key", "fp", own.alias("b"), F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("with")
    )
    return dealt.select(
        "t", "key", F.least("b", "with").alias("i"), F.greatest("b", "with").alias("j"),
        (F.col("b") > F.col("with")).cast("int").alias("side"), "fp",
    )


def near_links(prints: DataFrame, radius: int = 3, block_prints: int = BLOCK_PRINTS) -> DataFrame:
    """Links ``a, b`` among distinct fingerprints (long column ``fp``) that join all within the radius."""
    cell = ["t", "key", "i", "j"]
    return (
        cells(prints, radius, block_prints).repartition(*cell).sortWithinPartitions(*cell, "side", "fp")
        .mapInArrow(_links(radius), "a long, b long")
    )


def band_masks(radius: int) -> list[int]:
    """Signed 64-bit masks: one for each pair out of ``radius + 2`` bands."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    bands = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (x | y for x, y in combinations(bands, 2))]


# --- documents ------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``_id, _h`` (its key), ``fingerprint``, ``component_id``."""
    printed = cut_lineage(docs.select(*row_key(id_col, text_col), fingerprints(text_col, words).alias("fp")))
    least = cut_lineage(printed.groupBy("fp").agg(F.min("_id").alias("id")))
    roots = connected_components(near_links(least, radius))
    placed = least.join(roots, least["fp"] == roots["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = placed.select("fp", "root").join(named, "root").select("fp", "component_id")
    return printed.join(classes, "fp").select("_id", "_h", as_hex("fp").alias("fingerprint"), "component_id")


def drop_near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the document of the smallest id of each component; whole repeats of it stay with it."""
    found = near_duplicates(docs, words, radius, id_col, text_col)
    stay = found.where(F.col("_id").eqNullSafe(F.col("component_id"))).select("_id", "_h")
    keyed = packed(docs, *row_key(id_col, text_col))
    return keyed.join(stay, same_key(keyed, stay), "left_semi").select("_row.*")
