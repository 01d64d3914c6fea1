"""The timed gate (J1) on streams as Spark's own left-semi interval join.

A reading passes when some control of its key opened at or before it and is
still open.  The join's condition bounds a reading's time by the control's time
on both sides, so with a watermark on both inputs Spark drops a control once
no reading can meet it, and a reading once no control can still come for it: state
is bounded by the longest opening and the delays.  Rows stay columns in Spark's
state store; no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_ms, spark_interval, watermark_delay


def gate_join(
    readings: DataFrame, controls: DataFrame, key: str, ts: str, control_key: str, control_ts: str,
    duration_ms_col: str, max_duration, delay="0 seconds",
) -> DataFrame:
    """Readings (all columns, each row once) whose key is open at their time.

    ``max_duration`` bounds the controls' durations; a longer one is an error, as
    the rows it needs may be gone.  For durations without a bound see
    ``processors.gate_stream``.  Controls without a key, time or duration open
    nothing.
    """
    longest = duration_ms(max_duration)
    duration = F.col(duration_ms_col).cast("bigint")
    bounded = F.when(duration > longest, F.raise_error(F.lit(f"a control opens for more than {longest} ms")).cast("bigint"))
    until = F.timestamp_micros(F.unix_micros(F.col(control_ts)) + F.coalesce(bounded, duration) * 1000)
    opened = controls.select(
        F.col(control_key).alias("gate_key"), F.col(control_ts).alias("gate_from"), until.alias("gate_until")
    ).withWatermark("gate_from", watermark_delay(delay))
    rows = readings.withWatermark(ts, watermark_delay(delay))
    at = F.col(ts)
    is_open = (
        (F.col(key) == F.col("gate_key")) & (at >= F.col("gate_from")) & (at < F.col("gate_until"))
        & (at < F.col("gate_from") + F.expr(f"INTERVAL {spark_interval(longest)}"))
    )
    return rows.join(opened, is_open, "left_semi")
