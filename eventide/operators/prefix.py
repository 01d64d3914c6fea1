"""Running (prefix) aggregates that do not put a whole key into one task.

A plain ``sum/max over (partition by key order by t)`` sends every row of a
key to one task; for a key holding a large share of the data, or for an
un-keyed running value, that is a single-task bottleneck.  Here the order axis
is cut into buckets: the window runs per (key, bucket) and each bucket gets a
carry-in computed from a small per-bucket table (one row per key and bucket).
An un-keyed running value has one such row per bucket of the whole history, so
its table is scanned the same way once more: buckets within spans of
``SPAN_BUCKETS`` (a day of minutes), then spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {"sum": F.sum, "max": F.max, "min": F.min}

#: Buckets that one span of the upper level holds.
SPAN_BUCKETS = 1440


def _combine(kind: str, carry: Column, inner: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(inner, F.lit(0))
    if kind == "max":
        return F.greatest(carry, inner)  # greatest() skips nulls
    return F.least(carry, inner)


def key_struct(keys: list[str]) -> Column:
    """All key columns as one struct: never null, and null fields compare equal."""
    return F.struct(*[F.col(k) for k in keys])


def _carry_in(per_bucket: DataFrame, kcols: list[str], bucket: str, kind: str, spans: bool) -> DataFrame:
    """Per (key, bucket), ``kind`` over ``_bucket_val`` of the key's earlier buckets as ``_carry``.

    With ``spans`` the buckets are scanned within spans and the spans' totals
    carried in, so a task orders one span's buckets, or one row per span.
    """
    agg = _AGGS[kind]

    def earlier(value: str, by: list[str], order: str) -> Column:
        window = Window.partitionBy(*by).orderBy(order)
        return agg(value).over(window.rowsBetween(Window.unboundedPreceding, -1))

    if not spans:
        return per_bucket.select(*kcols, bucket, earlier("_bucket_val", kcols, bucket).alias("_carry"))
    by_span = [*kcols, "_span"]
    in_spans = per_bucket.select(
        *kcols, bucket, "_bucket_val", F.floor(F.col(bucket) / F.lit(SPAN_BUCKETS)).alias("_span")
    ).repartition(*by_span)
    totals = in_spans.groupBy(*by_span).agg(agg("_bucket_val").alias("_span_val"))
    before = totals.select(*by_span, earlier("_span_val", kcols, "_span").alias("_span_carry"))
    carry = _combine(kind, F.col("_span_carry"), earlier("_bucket_val", by_span, bucket))
    return in_spans.join(before.hint("shuffle_hash"), by_span).select(*kcols, bucket, carry.alias("_carry"))


def _bucketed(df: DataFrame, keys: list[str], bucket: str) -> tuple[DataFrame, str]:
    """``df`` with its key struct and a bucket that is never null (rows without one get the lowest)."""
    src = df.withColumn("_pbucket", F.coalesce(F.col(bucket), F.lit(-(1 << 63))))
    return (src.withColumn("_pkey", key_struct(keys)) if keys else src), "_pbucket"


def bucketed_running(
    df: DataFrame,
    keys: list[str],
    bucket: str,
    order: list[str],
    value: str,
    out: str,
    kind: str = "sum",
    inclusive: bool = True,
    spans: bool | None = None,
) -> DataFrame:
    """Add ``out`` = running ``kind`` of ``value`` over ``order`` within ``keys``.

    ``bucket`` must be a column that is non-decreasing along ``order`` within a
    key (for example ``floor(t / width)``).  Rows whose bucket is null come
    first, as nulls sort first.  ``inclusive=False`` excludes the current row.  Rows are hash-partitioned once by (key, bucket) and the
    row-level window reuses that partitioning; the small per-bucket table is
    aggregated from the input with a map-side combine (a narrow second read,
    not a second shuffle of the rows), windowed per key, and hash-joined.
    ``spans`` adds a level to that table (default: only without keys).
    """
    agg = _AGGS[kind]
    kcols = ["_pkey"] if keys else []
    src, bucket = _bucketed(df, keys, bucket)
    # The per-bucket table is aggregated from the un-shuffled input (map-side
    # combine, only the needed columns), not from the repartitioned rows.
    per_bucket = src.groupBy(*kcols, bucket).agg(agg(value).alias("_bucket_val"))
    src = src.repartition(*kcols, bucket)
    carry = _carry_in(per_bucket, kcols, bucket, kind, not keys if spans is None else spans)
    # Hash the small per-bucket table per partition of ``src``; never broadcast ``src``.
    joined = src.join(carry.hint("shuffle_hash"), [*kcols, bucket], "inner")
    frame_end = 0 if inclusive else -1
    w_in = (
        Window.partitionBy(*kcols, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, frame_end)
    )
    res = joined.withColumn(out, _combine(kind, F.col("_carry"), agg(value).over(w_in)))
    return res.select(*df.columns, out)


def bucketed_previous(
    df: DataFrame,
    keys: list[str],
    bucket: str,
    order: list[str],
    value: str,
    out: str,
) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row (by ``order``) within ``keys``.

    ``lag`` runs per (key, bucket); the first row of a bucket takes the last
    value of the key's previous non-empty bucket from a per-bucket table.
    """
    kcols = ["_pkey"] if keys else []
    src, bucket = _bucketed(df, keys, bucket)
    last = F.max_by(F.col(value), F.struct(*[F.col(c) for c in order]))
    per_bucket = src.groupBy(*kcols, bucket).agg(last.alias("_last"))
    src = src.repartition(*kcols, bucket)
    w_keys = Window.partitionBy(*kcols).orderBy(bucket)
    carry = per_bucket.select(*kcols, bucket, F.lag("_last").over(w_keys).alias("_prev_last"))
    joined = src.join(carry.hint("shuffle_hash"), [*kcols, bucket], "inner")
    w_in = Window.partitionBy(*kcols, bucket).orderBy(*order)
    first_in_bucket = F.row_number().over(w_in) == 1
    prev = F.when(first_in_bucket, F.col("_prev_last")).otherwise(F.lag(value).over(w_in))
    return joined.withColumn(out, prev).select(*df.columns, out)
