"""The operators of this package over the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables
from . import (
    chat, decontaminate, exact_dedup, html_text, language_id, licenses, nbest, periodic, pieces, secret_scan, simhash,
    token_counts, toxicity, variants,
)
from .common import held_out, prepare


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the workers can then import this package."""
    prepare(spark)
    return tables.read_table(spark, sf_dir, name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4, 2))
    profile = language_id.learn(docs, usable=~F.col("held_out"))
    found = docs.select("doc_id", "held_out", language_id.identify("text", profile).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose two texts hold control strings."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    log = chat.rows_as_events(rows.unionByName(hostile))
    return chat.digests(chat.render(chat.fold_events(log)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"), usable=~F.col("held_out"))
    found = docs.select("doc_id", "held_out", toxicity.score("text", model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", token_counts.token_counts("text", pieces.load()).alias("c"))
    return found.select("doc_id", "c.n_chunks", "c.n_tokens")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return exact_dedup.exact_duplicates(docs).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and costs of the four best segmentations (``ids``: the best), and whether decoding gives the text back."""
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", nbest.encode("text", pieces.load(), n=4, check=True).alias("e"))
    return found.select("doc_id", F.size("e.ids").cast("long").alias("n_pieces"), "e.*")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select(F.col("_id").alias("doc_id"), "fingerprint", "component_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.find_secrets("text").alias("spans"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.spelled(base), 256).alias("base_sha256"),
        secret_scan.spelled(F.col("spans")).alias("spans"),
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html_text.extract("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases by their exact places, and the notices whose blocks hold four fifths of their words."""
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.col("n_places").alias("n_base"), "first_word", "last_word",
        F.array_join("place_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def crc32_of(value: Column) -> Column:
    """Unsigned CRC-32 of a string's UTF-8 bytes."""
    return F.crc32(value.cast("binary"))


def with_planted_tails(text: Column, doc_id: Column) -> Column:
    """By a fixed rule on the id, the words of a tenth of the texts repeat from a place on."""
    words = F.array_remove(F.split(text, periodic.WHITE_SPACE), "")
    h = crc32_of(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
            F.element_at(w, (a + F.pmod(i - a, p) + 1).cast("int"))
        )), " ")

    whole = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w))), 1)
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(whole, text)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The explode keeps the texts' higher-order functions out of the Python function's argument.
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.array(with_planted_tails(F.col("text"), F.col("doc_id")))).alias("text")
    )
    found = docs.select("doc_id", periodic.periodic_runs("text").alias("r"))
    runs = F.arrays_zip("r.starts", "r.lengths", "r.periods")
    spelled = F.transform(runs, lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]))
    ended = F.transform(spelled, lambda line: F.concat(line, F.lit("\n")))
    pick = lambda values: F.get(values, F.col("r.strongest").cast("int"))
    found = found.select(
        "doc_id", F.size("r.starts").cast("long").alias("n_runs"), pick(F.col("r.starts")).alias("start"),
        pick(F.col("r.lengths")).alias("length"), pick(F.col("r.periods")).alias("period"),
        F.sha2(F.array_join(ended, ""), 256).alias("runs_sha256"), F.sha2("r.collapsed", 256).alias("collapsed_sha256"),
    )
    milli = F.floor(F.col("length") * 1000 / F.col("period")).cast("long")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


def with_planted_slips(docs: DataFrame) -> DataFrame:
    """``word``: every letter run of the texts; by a fixed rule on id and run, one in 97 loses a code point."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(variants.letter_runs(F.col("text"))).alias("run"),
    ).where(F.length("run") > 0)
    h = crc32_of(F.concat("_id", F.lit(":"), "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.pmod(h, F.lit(97)) == 0, shorter).otherwise(F.col("run")).alias("word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = with_planted_slips(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variants.group_variants(variants.frequent_words(words, least_chars=5, least_count=3))


REGISTRY = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_toxicity": op3_toxicity,
    "op4_token_counts": op4_token_counts,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash": op7_simhash,
    "op8_secret_scan": op8_secret_scan,
    "op9_html_text": op9_html_text,
    "op10_decontaminate": op10_decontaminate,
    "op11_license_scan": op11_license_scan,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}
