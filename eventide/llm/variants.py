"""Spelling variants by asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point makes one
of the other.  Of two near words the shorter (of equal ones, the lesser)
contributes two disjoint chunks, its halves; one edit leaves at least one of
them whole.  The other word contributes its positional grams of the halves'
lengths.  An edit behind a chunk leaves its place, an edit before it moves it by
the difference of the words' lengths, which is 0 or 1; so the grams that can
meet a chunk are those at its place moved by just that shift, and each word
contributes four: the halves of partners as long as itself and of partners one
shorter.  Chunks and grams are joined by (partner's length, half, shift, text)
and each pair is verified by its exact edit distance.  A pair that meets on
both halves is taken from the first only.

A key with very many grams is split: its grams are dealt over as many parts as
its size asks for, and its chunks go to each of them, so no task gets a whole
hot key and no pair is lost.

Everything is built from DataFrame functions; the words of the corpus are counted
with a map-side combine before any other step.

Defined results: null and empty texts have no words; rows that repeat count
again; of near words with equal counts the smallest in code-point order is the
form; a word without near words, or whose near words are not frequent enough,
is its own root; empty tables give no rows.  Roots exist because counts grow
along forms, at least by ``dominance``, which also bounds the chains' length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, lower_ascii

#: Fixed value: what separates words once A-Z is lower-cased.
NO_LETTERS = r"[^a-zÀ-ÿ]+"

#: Grams of one key that one part of it holds.
PART_GRAMS = 5_000


def letter_runs(text: Column) -> Column:
    """Maximal runs of Latin letters of a text, A-Z lower-cased, as an array that may hold empty strings."""
    return F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_LETTERS)


def frequent_words(words: DataFrame, word: str = "word", least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of the distinct words that are long and frequent enough."""
    long_enough = words.where(F.length(word) >= least_chars)
    return long_enough.groupBy(F.col(word).alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _parities(word: Column) -> Column:
    """For each code point, hashed to one of 64 bits, whether the word holds it an odd number of times.

    An inserted or deleted code point turns one bit, a replaced one two or none,
    so near words differ in two bits at most; most other candidates do not.
    """
    bits = F.transform(F.split(word, ""), lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64))))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))


def _chunks(counts: DataFrame) -> DataFrame:
    """Both halves of each word, for partners as long as the word and one longer."""
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    key = lambda part, shift, text: F.struct(
        size.alias("size"), F.lit(part).alias("part"), F.lit(shift).alias("shift"), text.alias("text")
    )
    first, second = F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)
    keys = F.array(*[key(part, shift, text) for shift in (0, 1) for part, text in ((0, first), (1, second))])
    return counts.select("word", "n", "bits", F.explode(keys).alias("key"))


def _grams(counts: DataFrame) -> DataFrame:
    """Of each word, the grams that can be halves of words as long (shift 0) or one shorter (shift 1)."""
    keys = []
    for shift in (0, 1):
        size = F.length("word") - F.lit(shift)
        half = F.floor(size / 2).cast("int")
        for part, text in ((0, F.substring("word", F.lit(1), half)), (1, F.substring("word", half + 1 + shift, size))):
            keys.append(F.struct(size.alias("size"), F.lit(part).alias("part"), F.lit(shift).alias("shift"), text.alias("text")))
    return counts.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("bits").alias("other_bits"),
        F.explode(F.array(*keys)).alias("key"),
    )


def near_pairs(counts: DataFrame, part_grams: int = PART_GRAMS) -> DataFrame:
    """``word, n, other, other_n``: each pair of near words once, from a table of distinct ``word, n``."""
    counts = cut_lineage(counts.select("word", "n", _parities(F.col("word")).alias("bits")))
    chunks, grams = _chunks(counts), _grams(counts)
    hot = grams.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_grams).select(
        "key", F.ceil(F.col("_n") / part_grams).cast("int").alias("_parts")
    )
    parts = F.coalesce("_parts", F.lit(1))
    chunks = chunks.join(hot, "key", "left").select(
        "key", "word", "n", "bits", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
    )
    grams = grams.join(hot, "key", "left").select(
        "key", "other", "other_n", "other_bits", F.pmod(F.xxhash64("other"), parts).cast("int").alias("_part")
    )
    half = F.floor(F.length("word") / 2).cast("int")
    met_before = (F.col("key.part") == 1) & (F.substring("word", F.lit(1), half) == F.substring("other", F.lit(1), half))
    alike = F.bit_count(F.col("bits").bitwiseXOR(F.col("other_bits"))) <= 2
    met = chunks.join(grams, ["key", "_part"]).where(alike & ((F.col("key.shift") == 1) | (F.col("word") < F.col("other"))))
    return met.where(~met_before & (F.levenshtein("word", "other", 1) == 1)).select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words that have a form: the last of the chain, found by doubling its steps."""
    steps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("_at"), F.col("root").alias("_root"))
        moved = steps.join(ahead, steps["root"] == ahead["_at"], "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("_moved")
        )
        moved = cut_lineage(moved)
        steps = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return steps


def group_variants(counts: DataFrame, dominance: int = 2, part_grams: int = PART_GRAMS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of a table of distinct ``word, n``.

    ``form`` is the near word of the largest count, if that is at least
    ``dominance`` (2 or more) times the word's own; ``root`` is the last word of
    the chain of forms.
    """
    if dominance < 2:
        raise ValueError("dominance must be 2 or more: chains of forms must end")
    counts = cut_lineage(counts)
    pairs = near_pairs(counts, part_grams)
    both = pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")
    ))
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top")
    )
    chosen = -F.col("top.less") >= F.col("n") * dominance
    found = cut_lineage(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("top.other")).alias("form"), F.when(chosen, -F.col("top.less")).alias("form_n"),
    ))
    roots = _roots(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
