"""Chunks of texts: found at once, solved once, remembered within bounds."""

import itertools
import random

import numpy as np
import pytest

from eventide.llm import nbest, pieces

ODD = ["", " ", "\n", "  a", "a  ", "a\n\n b", " \n ", "ä 漢字 🙂\t x", "▁ ▁", "\ud800 lone", "a\x00b \r\n c", "one", "one"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def _texts(rng, count):
    letters = ["a", "the", "ß", "漢", "🙂", " ", " ", "\n", "  ", "in", "9"]
    return ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(count)]


def test_chunk_places_gives_the_chunks_of_each_text():
    rng = random.Random(3)
    for texts in ([], [""], ["", ""], ODD, *(_texts(rng, 20) for _ in range(20))):
        distinct, occ, begin = pieces.chunk_places(texts)
        known = pieces.chunk_texts(distinct)
        assert len(set(known)) == len(known) and len(begin) == len(texts) + 1
        found = [[known[k] for k in occ[a:b]] for a, b in zip(begin, begin[1:])]
        assert found == [pieces.chunks(t) if t else [] for t in texts]


def test_a_chunk_is_solved_once_over_slices(vocabulary, monkeypatch):
    """Also where every text is a slice of its own."""
    solved, plain = [], nbest.solve
    monkeypatch.setattr(nbest, "SLICE_CHARS", 1)
    monkeypatch.setattr(nbest, "solve", lambda found, v: solved.extend(found) or plain(found, v))
    texts = ["the same words", "words the same", "same new words", "the same words"]
    nbest.Encoder(vocabulary, 4).n_best(texts)
    assert sorted(solved) == sorted({c for t in texts for c in pieces.chunks(t)})


@pytest.mark.parametrize("chunks_kept, ids_kept", [(0, 0), (3, 10**6), (10**6, 5), (8, 12)])
def test_what_is_remembered_is_bounded_and_changes_nothing(vocabulary, monkeypatch, chunks_kept, ids_kept):
    texts = ODD + _texts(random.Random(5), 60)
    want = [nbest.Encoder(vocabulary, 4).n_best([t])[0] for t in texts]
    monkeypatch.setattr(nbest, "SLICE_CHARS", 30)
    monkeypatch.setattr(nbest, "SOLVED_KEPT", chunks_kept)
    monkeypatch.setattr(nbest, "SOLVED_IDS_KEPT", ids_kept)
    encoder = nbest.Encoder(vocabulary, 4)
    for text, (listed, costs) in zip(texts, want):
        (got, got_costs), = encoder.n_best([text])
        assert got_costs == costs and [x.tolist() for x in got] == [x.tolist() for x in listed]
        assert len(encoder.chunks) <= chunks_kept and len(encoder.solved.ids) <= ids_kept
    whole = nbest.Encoder(vocabulary, 4).n_best(texts)
    assert [[x.tolist() for x in listed] for listed, _ in whole] == [[x.tolist() for x in listed] for listed, _ in want]


@pytest.mark.parametrize("n", [1, 2, 4, 6])
def test_ways_left_out_are_never_among_the_n_best(n):
    rng = random.Random(n)
    for _ in range(200):
        choices = [sorted([0] + rng.choices(range(4), k=rng.randrange(n))) for _ in range(rng.randrange(min(n, 4)))]
        every = sorted(
            itertools.product(*(range(len(c)) for c in choices)),
            key=lambda r: (sum(c[x] for c, x in zip(choices, r)), sum(map(bool, r)), [not x for x in r], r),
        )
        ways = nbest._ranks(n, *map(len, choices))
        assert sorted(ways, key=lambda r: sum(c[x] for c, x in zip(choices, r)))[:n] == every[:n]


def test_smallest_values_in_their_order():
    rng = np.random.default_rng(2)
    for _ in range(200):
        values = rng.integers(0, 6, size=rng.integers(0, 12))
        for most in range(5):
            assert nbest._smallest(values, most).tolist() == np.argsort(values, kind="stable")[:most].tolist()


def test_spell_joins_the_bytes_of_ids(vocabulary):
    for text in [t for t in ODD if "\ud800" not in t] + ["x" * 300]:
        (ids, _), = nbest.Encoder(vocabulary, 4)([text])
        assert nbest.spell(ids, vocabulary) == nbest.spell(ids[:], vocabulary) == text
    assert nbest.spell(None, vocabulary) is None and nbest.spell(np.array([]), vocabulary) == ""
    half = np.array(vocabulary.byte_ids)[[0x20, 0xC3]]  # the first byte of two
    assert nbest.spell(half, vocabulary) == "�"
    with pytest.raises(IndexError):
        nbest.spell(np.array([len(vocabulary.pieces)]), vocabulary)
