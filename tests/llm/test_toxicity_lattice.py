"""Disguises that the character lattice undoes, and plain text that it leaves alone."""

import pytest

from eventide.llm import queries, toxicity
from tests.conftest import SF001

PLAIN = (
    "you are an idiot and a stupid loser , the good book is on the table . we will see it in the evening , "
    "all of them were at the ball game and had coffee . his class passed the test as usual . what a mess "
)


@pytest.fixture(scope="module")
def plain():
    counts = toxicity._trigram_counts([PLAIN * 20])
    words = ["idiot", "stupid", "loser", "ass", "you"]
    return toxicity._tables(toxicity.Model(toxicity._log_probabilities(counts, words).tobytes(), (), 0.0, 0.0))[0]


@pytest.mark.parametrize("seen,meant", [
    ("idio7", "idiot"), ("a55", "ass"), ("a$$", "ass"), ("1 d 1 0 t", "idiot"), ("a s s", "ass"), ("iidiiot", "idiot"),
    ("sstupid", "stupid"), ("s t u p 1 d", "stupid"), ("st.u.p.i.d", "stupid"), ("y o u i d i o t", "you idiot"),
    ("1d10t", "idiot"), ("i-d-i-o-t", "idiot"), ("$tup!d", "stupid"), ("l0000ser", None), ("looooser", "loser"),
    ("id10+", "idiot"), ("i.d.i.0.7", "idiot"), ("y 0 u 1 d 1 0 t", "you idiot"), ("iiidiooot", "idiot"), ("l_o_s_e_r", "loser"),
    ("!d!ot", "idiot"),
])
def test_disguises(plain, seen, meant):
    text = f"well , {seen} , he said"
    assert toxicity.suspicious([text])[0]
    if meant is not None:
        assert toxicity.restore(text, plain) == f"well , {meant} , he said"


@pytest.mark.parametrize("text", [
    "the plain text, no. 7", "on 3 4 5 and 12.03.2024 at 10:30", "all good books will see coffee in class!", "what a mess! the ball | game",
    "version 1.2.3 of 100 % at 5 + 6 = 11", "it is at the table, as we see it", "he had 1 2 3 4 books", "a b",
])
def test_plain_text_and_numbers_stay(plain, text):
    assert toxicity.restore(text, plain) == text


def test_suspicious_covers_all_spans(plain):
    """The cheap test passes every text in which a span would be decoded otherwise than it stands."""
    import random
    rng = random.Random(6)
    bits = ["a", "ss", "i", "1", "0", "$", "!", "|", " ", ".", "-", "dd", "uu", "ttt", "é", "the", "7", "+", "  ", "\n"]
    for _ in range(3_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        if toxicity.restore(text, plain) != text:
            assert toxicity.suspicious([text])[0], text


def test_given_clean_texts_hardly_change(spark):
    """Words of the given texts that are labelled clean stay as they are, but for a few."""
    docs = queries.read_table(spark, SF001, "documents")
    labels = queries.read_table(spark, SF001, "labels")
    texts = [r["text"].lower() for r in docs.join(labels.where("toxic = 0"), "doc_id").collect() if r["text"]]
    counts = toxicity._trigram_counts(texts)
    plain = toxicity._tables(toxicity.Model(toxicity._log_probabilities(counts, []).tobytes(), (), 0.0, 0.0))[0]
    changed = total = 0
    for text in texts:
        before, after = toxicity.WORD.findall(text), set(toxicity.WORD.findall(toxicity.restore(text, plain)))
        total += len(before)
        changed += sum(w not in after for w in before)
    assert changed < 0.03 * total
