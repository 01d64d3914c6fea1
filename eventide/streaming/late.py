"""Late-row split on a stream (L4).

Spark drops rows behind its own watermark before user code sees them, so the
split is done in ``foreachBatch`` with the batch operator: rows are ordered by
arrival inside the micro-batch, and the largest event time of all earlier
batches is carried in a small table in the checkpoint folder: one row per
batch id holding the running maximum, so a batch reads only its
predecessor's row and a replayed batch rewrites its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.late import late_split


def previous_mark(spark, store: str, batch_id: int, col: str):
    """The cumulative value written by the previous batch.

    Each batch writes one row holding the running value up to itself, so a
    batch normally reads a single one-row file, not the whole history; only if
    that file is missing (the first batch, or a batch id gap) are all earlier
    marks scanned.
    """
    if batch_id > 0:
        row = _stored(spark, f"{store}/batch={batch_id - 1}")
        if row is not None and (found := row.select(col).first()) is not None:
            return found[0]
    prior = _stored(spark, store)
    return None if prior is None else prior.where(F.col("batch_id") < batch_id).agg(F.max(col)).first()[0]


def _stored(spark, path: str) -> DataFrame | None:
    """The table at ``path``; None only if the path does not exist.  Any other failure fails the batch."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def late_split_batches(
    ts_ms: str,
    arrival: str,
    seq: str,
    delay,
    store: str,
    sink: Callable[[DataFrame, int], None],
):
    """``foreachBatch`` body: mark late rows of the batch and hand them to ``sink``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carry = previous_mark(spark, store, batch_id, "max_ts")
        marked = late_split(batch, ts_ms, arrival, seq, delay, carry_max=carry)
        marked = marked.persist()
        sink(marked, batch_id)
        running = F.greatest(F.max(ts_ms), F.lit(carry).cast("bigint"))
        top = marked.agg(running.alias("max_ts")).withColumn("batch_id", F.lit(batch_id))
        top.write.mode("overwrite").parquet(f"{store}/batch={batch_id}")
        marked.unpersist()

    return run
