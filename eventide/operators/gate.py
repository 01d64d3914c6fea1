"""Timed gate between two inputs.

A control row (key, time c, duration d) opens its key for ``[c, c + d)``; a
later, longer control extends the opening and a shorter one changes nothing,
so a reading passes exactly when its time lies in the union of the control
intervals of its key.  Equivalently: ``ts < max(c + d)`` over the key's
controls with ``c <= ts``.

That running maximum is computed over the union of both inputs, ordered by
time with controls first on ties.  No reading is paired with controls, so a
key with many controls costs no more than its rows, and the running max is
bucketed by time so one busy key is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_ms
from .prefix import bucketed_running


def _open_readings(both: DataFrame, bucket) -> DataFrame:
    """Rows ``_k, _t, _kind (0 control, 1 reading), _s, _end, _row`` -> passed ``_row``s."""
    both = both.withColumn("_b", F.floor(F.col("_t") / F.lit(duration_ms(bucket))).cast("bigint"))
    opened = bucketed_running(
        both, ["_k"], "_b", ["_t", "_kind", "_s"], "_end", "_open_until", kind="max"
    )
    passed = opened.where((F.col("_kind") == 1) & (F.col("_t") < F.col("_open_until")))
    return passed.select("_row.*")


def timed_gate(
    readings: DataFrame,
    controls: DataFrame,
    key: str,
    ts_ms: str,
    control_key: str,
    control_ts_ms: str,
    duration_ms_col: str,
    seq: str | None = None,
    bucket="1 hour",
) -> DataFrame:
    """Readings whose key is open at their time; returns the readings' columns."""
    r = readings.select(
        F.col(key).alias("_k"),
        F.col(ts_ms).alias("_t"),
        F.lit(1).alias("_kind"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("_s"),
        F.lit(None).cast("bigint").alias("_end"),
        F.struct(*readings.columns).alias("_row"),
    )
    c = controls.select(
        F.col(control_key).alias("_k"),
        F.col(control_ts_ms).alias("_t"),
        F.lit(0).alias("_kind"),
        F.lit(0).cast("bigint").alias("_s"),
        (F.col(control_ts_ms) + F.col(duration_ms_col)).cast("bigint").alias("_end"),
        F.lit(None).cast(r.schema["_row"].dataType).alias("_row"),
    )
    return _open_readings(r.unionByName(c), bucket)


def timed_gate_one_input(
    df: DataFrame,
    key: str,
    ts_ms: str,
    is_control: Column,
    duration_ms_col: Column,
    payload: list[str],
    seq: str | None = None,
    bucket="1 hour",
) -> DataFrame:
    """J1 when controls and readings are rows of one input (one scan, no union).

    ``is_control`` marks control rows (opening ``[ts, ts + duration)``); the
    others are readings and are returned with the ``payload`` columns.
    """
    ctl = F.coalesce(is_control, F.lit(False))
    both = df.select(
        F.col(key).alias("_k"),
        F.col(ts_ms).alias("_t"),
        F.when(ctl, F.lit(0)).otherwise(F.lit(1)).alias("_kind"),
        (F.col(seq) if seq else F.lit(0)).cast("bigint").alias("_s"),
        F.when(ctl, (F.col(ts_ms) + duration_ms_col).cast("bigint")).alias("_end"),
        F.struct(*[F.col(c) for c in payload]).alias("_row"),
    )
    return _open_readings(both, bucket)
