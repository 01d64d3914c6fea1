"""SentencePiece encoding with n-best segmentations, and decoding.

A forward Viterbi pass over a chunk's piece lattice gives the least cost of
reaching each place.  A backward A* search from the end uses it as heuristic:
it is exact, so complete segmentations leave the queue in order of cost.

A text is a row of chunks.  Its best segmentation joins the chunks' best ones;
its next best ones deviate in the chunks with the smallest gaps between best and
second best.  Only the ``n - 1`` occurrences with the smallest gaps can take part
in the ``n`` best of the text, so only these chunks are searched; the gap of a
chunk is the least detour by one edge into its best path, which the forward
scores give without a search.

Ties: of equal cost, fewer pieces come first, then the segmentation whose last
pieces are longer; in a text, the detour in the earlier chunk.

Defined results: null gives null ids and an empty list of costs; empty text
gives no ids, with the one cost 0; a text with fewer than ``n`` segmentations
lists all it has; texts and chunks of any length are encoded whole; equal rows get
equal results; an empty table gives no rows.  ``decode(encode(text)) == text`` for every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import prod
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import code_points, slices
from .pieces import COUNT_BITS, Lattice, Vocabulary, chunk_places, chunk_texts, lattice

ENCODED = "ids array<int>, costs array<long>, next_ids array<array<int>>"
CHECKED = ENCODED + ", restored boolean"


def forward(text: str, pieces: Lattice) -> tuple[list[int], list[int]]:
    """For each place: the least weight of reaching it, and where its last edge starts."""
    best, start = [0], [0]
    weight, ends, longest = pieces.weight.get, pieces.ends, pieces.longest
    for j in range(1, len(text) + 1):
        part = text[j - 1]
        least, at = best[-1] + (weight(part) or pieces.bytes_weight(part)), j - 1
        if part in ends:
            for i in range(j - 2, max(j - longest, 0) - 1, -1):
                part = text[i:j]
                w = weight(part)
                if w and best[i] + w <= least:  # of equal weight, the longer edge
                    least, at = best[i] + w, i
                if part not in ends:
                    break
        best.append(least)
        start.append(at)
    return best, start


def best_and_gap(text: str, pieces: Lattice) -> tuple[tuple[int, ...], int, int | None]:
    """Ids and cost of a chunk's best segmentation, and the gap to the second best (None: there is none)."""
    best, start = forward(text, pieces)
    parts: list[tuple[int, ...]] = []
    gap = None
    weight, ends, longest = pieces.weight.get, pieces.ends, pieces.longest
    j = len(text)
    while j:
        for i in range(j - 1, max(j - longest, 0) - 1, -1):
            part = text[i:j]
            if i != start[j]:
                w = weight(part) or (pieces.bytes_weight(part) if i == j - 1 else 0)
                if w and (gap is None or best[i] + w - best[j] < gap):
                    gap = best[i] + w - best[j]
            if part not in ends:
                break
        parts.append(pieces.ids(text[start[j] : j]))
        j = start[j]
    return tuple(x for part in reversed(parts) for x in part), best[-1] >> COUNT_BITS, gap


def n_best(text: str, pieces: Lattice, n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The ``n`` cheapest segmentations of a chunk as (cost, ids), by backward A*.

    The heuristic is exact, so each queued end of a segmentation stands for a
    complete one of just that cost, and no two for the same: only as many as
    are still to be found need stay.  They are held in the order of their
    starts from the end of the text, which is the order of ties; what an end
    grows into takes its place.  Ends share their cells.
    """
    best, _ = forward(text, pieces)
    queue: list[tuple[int, int, int, tuple]] = [(best[-1], len(text), 0, (len(text), None))]
    found: list[tuple[int, tuple[int, ...]]] = []
    while queue and len(found) < n:
        at = min(range(len(queue)), key=lambda k: queue[k][0])
        _, j, behind, cell = queue.pop(at)
        if not j:
            ids: list[int] = []
            while cell[1]:
                ids += pieces.ids(text[cell[0] : cell[1][0]])
                cell = cell[1]
            found.append((behind >> COUNT_BITS, tuple(ids)))
            continue
        queue[at:at] = [(best[i] + behind + w, i, behind + w, (i, cell)) for i, w in reversed(pieces.edges(text, j))]
        if len(queue) > n - len(found):
            kept = sorted(range(len(queue)), key=lambda k: queue[k][0])[: n - len(found)]
            queue = [queue[k] for k in sorted(kept)]
    return found


# --- many chunks at once ----------------------------------------------------

SHORT = 64  # chunks up to this length are solved together, as numpy lanes
SLICE_CHARS = 1_500_000
DETOURS_KEPT, DETOUR_IDS_KEPT = 50_000, 5_000_000
SOLVED_KEPT, SOLVED_IDS_KEPT = 200_000, 2_000_000
SHIFT = 16  # weights of short chunks: cost << SHIFT | pieces, within 64 bits
FAR = np.int64(1) << np.int64(60)


@dataclass(frozen=True)
class Trie:
    """Forward trie of the pieces: an open-addressing table of (node, character class) -> node."""

    classes: np.ndarray  # code point -> class, 0: in no piece
    width: int
    keys: np.ndarray
    nodes: np.ndarray
    weight: np.ndarray  # of the piece that ends at a node, FAR: none
    ids: np.ndarray

    def step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Children, 0 where there is none (0 is the root, which is no child)."""
        key = node.astype(np.int64) * self.width + symbol
        slot = _slot(key, len(self.keys))
        held = self.keys[slot]
        out = np.where(held == key, self.nodes[slot], 0)
        open_ = np.flatnonzero((held != key) & (held >= 0))
        while len(open_):  # the few whose slot another key holds look on
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.nodes[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return np.where(symbol > 0, out, 0)


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (size - 1)


@lru_cache(maxsize=2)
def trie(vocabulary: Vocabulary) -> Trie:
    pieces = lattice(vocabulary)
    letters = sorted({c for p in pieces.weight for c in p})
    classes = np.zeros(0x110000, dtype=np.int32)
    classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    width = len(letters) + 1
    child: dict[int, int] = {}
    weight, ids = [FAR], [-1]
    for piece, w in pieces.weight.items():
        node = 0
        for c in piece:
            key = node * width + int(classes[ord(c)])
            if key not in child:
                child[key] = len(weight)
                weight.append(FAR)
                ids.append(-1)
            node = child[key]
        weight[node], ids[node] = (w >> COUNT_BITS) << SHIFT | 1, pieces.id_of[piece]
    size = 1 << (4 * len(child)).bit_length()
    keys, nodes = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
    every = np.fromiter(child, dtype=np.int64, count=len(child))
    for key, slot in zip(every.tolist(), _slot(every, size).tolist()):
        while keys[slot] >= 0:
            slot = (slot + 1) & (size - 1)
        keys[slot], nodes[slot] = key, child[key]
    return Trie(classes, width, keys, nodes, np.array(weight, dtype=np.int64), np.array(ids, dtype=np.int32))


@dataclass(frozen=True)
class Solved:
    """Per chunk: cost, gap (FAR: none) and ids, those of chunk k at ``ids[begin[k] : begin[k + 1]]``."""

    cost: np.ndarray
    gap: np.ndarray
    ids: np.ndarray
    begin: np.ndarray

    def spread(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks ``at`` in a row, and where each one's begin (one more at the end)."""
        counts = np.diff(self.begin)[at]
        upto = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        return self.ids[np.repeat(self.begin[at] - upto[:-1], counts) + np.arange(upto[-1])], upto

    def pick(self, at: np.ndarray) -> Solved:
        return Solved(self.cost[at], self.gap[at], *self.spread(at))

    def join(self, more: Solved) -> Solved:
        return Solved(
            np.concatenate([self.cost, more.cost]), np.concatenate([self.gap, more.gap]),
            np.concatenate([self.ids, more.ids]), np.concatenate([self.begin, self.begin[-1] + more.begin[1:]]),
        )


def solve(found: list[str], vocabulary: Vocabulary) -> Solved:
    """Best segmentations of distinct chunks; the same as ``best_and_gap`` of each."""
    pieces, letters = lattice(vocabulary), trie(vocabulary).classes
    cost, gap = np.zeros(len(found), dtype=np.int64), np.full(len(found), FAR)
    owners, pieces_of = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int32)]
    codes, starts = code_points(found)
    strange = np.concatenate([[0], np.cumsum(letters[codes] == 0)])
    plain = (np.diff(starts) <= SHORT) & (strange[starts[1:]] == strange[starts[:-1]])
    # a character that is in pieces but is none itself also needs bytes
    lone = np.concatenate([[0], np.cumsum(_alone(vocabulary)[codes])])
    plain &= lone[starts[1:]] == lone[starts[:-1]]
    for k in np.flatnonzero(~plain):
        own, c, g = best_and_gap(found[k], pieces)
        owners.append(np.full(len(own), k))
        pieces_of.append(np.array(own, dtype=np.int32))
        cost[k], gap[k] = c, FAR if g is None else g >> COUNT_BITS
    lanes = np.flatnonzero(plain)
    if len(lanes):
        for owner, ids in _solve_short(codes, starts, lanes, trie(vocabulary), cost, gap):
            owners.append(owner)
            pieces_of.append(ids)
    owner = np.concatenate(owners)
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(found)))]).astype(np.int64)
    return Solved(cost, gap, np.concatenate(pieces_of)[np.argsort(owner, kind="stable")], begin)


@lru_cache(maxsize=2)
def _alone(vocabulary: Vocabulary) -> np.ndarray:
    """Code points that occur in pieces but are no piece by themselves."""
    t = trie(vocabulary)
    points = np.flatnonzero(t.classes)
    single = t.weight[t.step(np.zeros(len(points), dtype=np.int32), t.classes[points])] < FAR
    out = np.zeros(0x110000, dtype=bool)
    out[points[~single]] = True
    return out


def _solve_short(codes, starts, lanes, t: Trie, cost, gap) -> list[tuple[np.ndarray, np.ndarray]]:
    """Fills in cost and gap of the lanes' chunks; returns (chunk, id) of their pieces, first pieces first."""
    size = np.diff(starts)[lanes]
    order = np.argsort(-size, kind="stable")
    lanes, size = lanes[order], size[order]
    base = starts[lanes]
    rows = _edges(codes, starts, lanes, t)
    longest = int(size[0])
    active = len(size) - np.searchsorted(size[::-1], np.arange(longest + 1), side="left")
    best = np.zeros((longest + 1, len(lanes)), dtype=np.int64)
    back = np.zeros((longest + 1, len(lanes)), dtype=np.uint8)
    for j in range(1, longest + 1):
        k = active[j]
        least = np.full(k, 2 * FAR)
        for n in range(1, min(j, len(rows)) + 1):
            here = best[j - n, :k] + t.weight[rows[n - 1][base[:k] + (j - n)]]
            better = here <= least  # of equal weight, the longer edge
            least = np.where(better, here, least)
            back[j, :k][better] = n
        best[j, :k] = least
    every = np.arange(len(lanes))
    cost[lanes] = best[size, every] >> SHIFT
    least_gap = np.full(len(lanes), FAR)
    at, live = size.copy(), every
    taken: list[tuple[np.ndarray, np.ndarray]] = []
    while len(live):
        j = at[live]
        step = back[j, live].astype(np.int64)
        for n in range(1, len(rows) + 1):
            may = np.flatnonzero((j >= n) & (step != n))
            x = live[may]
            i = j[may] - n
            detour = best[i, x] + t.weight[rows[n - 1][base[x] + i]] - best[j[may], x]
            least_gap[x] = np.minimum(least_gap[x], np.where(detour < FAR // 2, detour, FAR))
        node = np.zeros(len(live), dtype=np.int32)
        for n in range(1, len(rows) + 1):
            own = step == n
            node[own] = rows[n - 1][base[live[own]] + j[own] - n]
        taken.append((lanes[live], t.ids[node]))
        at[live] = j - step
        live = live[at[live] > 0]
    gap[lanes] = np.where(least_gap < FAR, least_gap >> SHIFT, FAR)
    return taken[::-1]


def _edges(codes, starts, lanes, t: Trie) -> list[np.ndarray]:
    """``rows[n - 1][p]``: the trie node of the ``n`` characters from place ``p`` on, 0 if they start no piece."""
    symbols = t.classes[codes]
    stop = np.zeros(len(codes), dtype=np.int64)
    sizes = np.diff(starts)
    stop[:] = np.repeat(starts[1:], sizes)
    wanted = np.zeros(len(sizes), dtype=bool)
    wanted[lanes] = True
    live = np.flatnonzero(np.repeat(wanted, sizes))
    node = np.zeros(len(live), dtype=np.int32)
    rows: list[np.ndarray] = []
    while len(live):
        node = t.step(node, symbols[live + len(rows)])
        row = np.zeros(len(codes), dtype=np.int32)
        row[live] = node
        rows.append(row)
        on = (node > 0) & (live + len(rows) < stop[live])
        live, node = live[on], node[on]
    return rows


class Encoder:
    """Encodes slices of texts; remembers solved chunks, and the n best of chunks that give small gaps."""

    def __init__(self, vocabulary: Vocabulary, n: int) -> None:
        self.vocabulary, self.n = vocabulary, n
        self._keep(pa.array([], pa.large_binary()), solve([], vocabulary))
        self.detours: dict[str, list[tuple[int, np.ndarray]]] = {}
        self.held = 0  # ids in the detours

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]]]:
        """Per text: ids of the best segmentation and the costs of the ``n`` best."""
        return [(listed[0], costs) for listed, costs in self.n_best(texts)]

    def n_best(self, texts: list[str]) -> list[tuple[list[np.ndarray], list[int]]]:
        """Per text: ids and costs of the ``n`` best segmentations."""
        out: list[tuple[list[np.ndarray], list[int]]] = []
        for a, b in slices(texts, SLICE_CHARS):
            out += self._slice(texts[a:b])
        return out

    def _slice(self, texts: list[str]) -> list[tuple[list[np.ndarray], list[int]]]:
        distinct, occ, begin = chunk_places(texts)
        at = self._places(distinct)
        solved, occ_at = self.solved, at[occ]
        ids, upto = solved.spread(occ_at)
        total = np.concatenate([[0], np.cumsum(solved.cost[occ_at])])
        gaps = solved.gap[occ_at]
        out = []
        for k in range(len(texts)):
            a, b = begin[k], begin[k + 1]
            cuts = upto[a : b + 1] - upto[a]
            out.append(self._listed(int(total[b] - total[a]), distinct, occ[a:b], gaps[a:b], ids[upto[a] : upto[b]], cuts))
        self._forget(distinct, at)
        return out

    def _keep(self, chunks: pa.Array, solved: Solved) -> None:
        """Chunk k of ``solved`` is ``chunks[k]``."""
        self.chunks, self.solved = chunks, solved

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Places of chunks in ``solved``, where those not yet in it are put."""
        at = pc.fill_null(pc.index_in(distinct, value_set=self.chunks), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        at[new] = np.arange(len(new)) + len(self.chunks)
        fresh = distinct.take(pa.array(new))
        self._keep(pa.concat_arrays([self.chunks, fresh]), self.solved.join(solve(chunk_texts(fresh), self.vocabulary)))
        return at

    def _forget(self, distinct: pa.Array, at: np.ndarray) -> None:
        """Beyond the bounds only the last slice's chunks stay solved, or none if these are too many."""
        def full() -> bool:
            return len(self.chunks) > SOLVED_KEPT or len(self.solved.ids) > SOLVED_IDS_KEPT

        if full():
            self._keep(distinct, self.solved.pick(at))
        if full():
            self._keep(pa.array([], pa.large_binary()), self.solved.pick(at[:0]))

    def _listed(
        self, least: int, distinct: pa.Array, occ: np.ndarray, gaps: np.ndarray, ids: np.ndarray, cuts: np.ndarray
    ) -> tuple[list[np.ndarray], list[int]]:
        """Ids and costs of the ``n`` best segmentations of a text.

        Its chunk k is ``distinct[occ[k]]``, whose best ids lie at ``cuts[k:k + 2]``.
        """
        if len(self.detours) > DETOURS_KEPT or self.held > DETOUR_IDS_KEPT:
            self.detours.clear()
            self.held = 0
        near = _smallest(gaps, self.n - 1)
        near = np.sort(near[gaps[near] < FAR]).tolist()
        choices = [self._detours(c) for c in chunk_texts(distinct.take(pa.array(occ[near], pa.int64())))]
        ways = _ranks(self.n, *map(len, choices))
        costs = [(least + sum(c[r][0] for c, r in zip(choices, ranks)), ranks) for ranks in ways]
        ranked = sorted(costs, key=itemgetter(0))[: self.n]
        listed = []
        for _, ranks in ranked:
            parts, at = [], 0
            for k, choice, rank in zip(near, choices, ranks):
                if rank:
                    parts += [ids[at : cuts[k]], choice[rank][1]]
                    at = cuts[k + 1]
            listed.append(np.concatenate([*parts, ids[at:]]) if parts else ids)
        return listed, [cost for cost, _ in ranked]

    def _detours(self, chunk: str) -> list[tuple[int, np.ndarray]]:
        """How much more than the best each of a chunk's ``n`` best costs, and its ids."""
        if chunk not in self.detours:
            listed = n_best(chunk, lattice(self.vocabulary), self.n)
            self.detours[chunk] = [(c - listed[0][0], np.array(x, dtype=np.int32)) for c, x in listed]
            self.held += sum(len(x) for _, x in listed)
        return self.detours[chunk]


def _smallest(values: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` smallest values in their order, of equal ones the first."""
    if not 0 < most < len(values):
        return np.argsort(values, kind="stable")[:most]
    may = np.flatnonzero(values <= np.partition(values, most - 1)[most - 1])
    return may[np.argsort(values[may], kind="stable")[:most]]


@lru_cache(maxsize=1000)
def _ranks(n: int, *sizes: int) -> list[tuple[int, ...]]:
    """Ways to take one of each chunk's segmentations that can be in the ``n`` best, those of equal cost in their order.

    A way with any lower ranks costs no more and comes before, so one with ``n`` such ways is left out.
    """
    found: list[tuple[int, ...]] = [()]
    for size in sizes:
        found = [(*r, x) for r in found for x in range(min(size, n // prod(k + 1 for k in r)))]
    return sorted(found, key=lambda r: (sum(map(bool, r)), [not x for x in r], r))


def encode(text: Column | str, vocabulary: Vocabulary, n: int = 4, check: bool = False) -> Column:
    """Struct column: ``ids`` of the best segmentation, ``costs`` of the ``n`` best in millionths, ``next_ids`` of the others.

    With ``check``, ``restored`` says whether decoding the ids gives the text back.
    """

    @F.arrow_udf(CHECKED if check else ENCODED)
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary, n)
        for batch in batches:
            texts = batch.to_pylist()
            rows = encoder.n_best([t or "" for t in texts])
            null = [t is None for t in texts]
            made = {
                "ids": _lists([listed[0] for listed, _ in rows], null),
                "costs": _lists([[] if t is None else costs for t, (_, costs) in zip(texts, rows)], dtype=np.int64),
                "next_ids": _lists_of_lists([[] if t is None else listed[1:] for t, (listed, _) in zip(texts, rows)]),
            }
            if check:
                restored = [spell(None if t is None else listed[0], vocabulary) == t for t, (listed, _) in zip(texts, rows)]
                made["restored"] = pa.array(restored, pa.bool_())
            yield pa.StructArray.from_arrays(list(made.values()), names=list(made))

    return encoded(text)


def _offsets(lists: list) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32))


def _lists(lists: list, null: list[bool] | None = None, dtype: type = np.int32) -> pa.Array:
    """Arrays as one column, without going through Python numbers; null where ``null`` says so."""
    values = pa.array(np.concatenate([np.zeros(0, dtype=dtype), *(np.asarray(x, dtype=dtype) for x in lists)]))
    return pa.ListArray.from_arrays(_offsets(lists), values, mask=None if null is None else pa.array(null, pa.bool_()))


def _lists_of_lists(rows: list[list[np.ndarray]]) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(rows), _lists([x for row in rows for x in row]))


def spell(ids: np.ndarray | None, vocabulary: Vocabulary) -> str | None:
    """The text of an array of ids."""
    if ids is None:
        return None
    spelled = _spelled(vocabulary).take(pa.array(np.asarray(ids, dtype=np.int64)))
    _, bounds, data = spelled.buffers()
    last = np.frombuffer(bounds, dtype=np.int64)[spelled.offset + len(spelled)] if len(spelled) else 0
    return str(memoryview(data)[:last], "utf-8", "replace")[1:] if last else ""


@lru_cache(maxsize=2)
def _spelled(vocabulary: Vocabulary) -> pa.Array:
    return pa.array(lattice(vocabulary).spelled, pa.large_binary())


def decode(ids: Column | str, vocabulary: Vocabulary) -> Column:
    """The text that ids spell, without the extra space in front; null gives null."""

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([spell(r, vocabulary) for r in rows], dtype=object)

    return decoded(ids)
