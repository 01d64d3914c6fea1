"""A document-cleaning pipeline: each stage calls one operator of ``eventide.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps.  ``run`` applies them to ``documents`` with every
stage's result written as Parquet and read again; a stage's files go once the
next stage's are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import decontaminate, exact_dedup, language_id, nbest, pieces, simhash
from eventide.llm.common import prepare, use_checkpoint_dir
from eventide.sources.tables import read_table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language can not be told: null texts and texts without a letter."""
    prepare(spark)
    return language_id.keep_known(docs, language_id.learn(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each distinct text stays, that with the largest doc_id."""
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within 3 bits, that with the smallest doc_id stays."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs, words=3, radius=3)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text and the costs of its four best segmentations; ids that do not decode to the text are an error."""
    prepare(spark)
    found = docs.select("doc_id", nbest.encode("text", pieces.load(), n=4, check=True).alias("e"))
    ids = F.when(F.col("e.restored"), F.col("e.ids")).otherwise(F.raise_error(F.lit("ids do not decode to the text")))
    return found.select("doc_id", F.size("e.ids").cast("long").alias("n_pieces"), ids.alias("ids"), "e.costs")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_text),
    ("SentencePiece encoding and decoding", encode),
]

#: The stages learn models and link texts by fingerprints, which SQL can not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _remove(spark, f"{folder}/{k - 1}")  # its successor is written: nothing reads it again
    return docs


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes a stage's files, on whatever file system they are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
