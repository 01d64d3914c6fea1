"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that identify a row: its id and a hash of its text.

    Rows that repeat one id with another text stay apart; whole repeats share
    a key and so share every decision.
    """
    return [F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_h")]


def packed(docs: DataFrame, *more: Column) -> DataFrame:
    """``docs`` as one struct column ``_row``, so that its names clash with none, and ``more`` columns of it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *more)


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["_id"].eqNullSafe(right["_id"]) & (left["_h"] == right["_h"])


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; null ids are never held out."""
    return F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False)
    )


#: Rows that a Python worker is handed at once: whole texts may be long, so few.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Ships this package to the workers and bounds what they are handed at once."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and read it from there."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    return df.checkpoint()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset and Spark is local (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(folder)


def least(rows: DataFrame, by: str, order: str, most: int, spread: str, buckets: int = 16) -> DataFrame:
    """Of each ``by``, the ``most`` first rows by ``order``, in two steps.

    The first keeps as many per (``by``, bucket of the hash column ``spread``), so the task
    that has all of a ``by`` reads at most ``buckets`` times ``most`` rows, whatever their number.
    """
    def cut(df: DataFrame, *keys: Column | str) -> DataFrame:
        ranked = df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        return ranked.where(F.col("_k") <= most).drop("_k")

    return cut(cut(rows, by, F.pmod(F.col(spread), F.lit(buckets))), by)
