"""Row routing: threshold alarms (T3, T4) and the daily click limiter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000

# Alarm and warning texts.
FREEZING_TEMPLATE = "Freezing Alarm for "
LOW_TEMPERATURE_TEXT = "温度小于32度"
CLICK_WARNING = "Click over {n} times today."


def threshold_alarm(
    df: DataFrame, key: str, value: str, below: float, prefix: str | None = FREEZING_TEMPLATE,
    fixed_text: str | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """One message per reading with ``value < below``; stateless."""
    msg = F.lit(fixed_text) if fixed_text is not None else F.concat(
        F.lit(prefix), F.col(key).cast("string")
    )
    return df.where(F.col(value) < F.lit(below)).select(*(keep or [key]), msg.alias("msg"))


def daily_limit(
    df: DataFrame,
    keys: list[str],
    ts_ms: str,
    seq: str,
    max_count: int,
    inclusive_quirk: bool = True,
    route: str = "route",
) -> DataFrame:
    """Route each click as 'pass' or 'warn' per key and UTC day; drop the rest.

    The reference checks ``count > max`` before incrementing, so ``max + 1``
    clicks pass (``inclusive_quirk=True``); the next one raises the single
    warning of the day and all later ones are dropped.  The cut is a
    ``row_number() <= k`` filter, which Catalyst plans as a WindowGroupLimit:
    each map partition keeps at most k rows per (key, day) before the shuffle,
    so a key with millions of clicks ships only k rows.
    """
    passing = max_count + 1 if inclusive_quirk else max_count
    day = F.floor(F.col(ts_ms) / F.lit(DAY_MS)).cast("bigint")
    w = Window.partitionBy(*keys, "_day").orderBy(F.col(ts_ms), F.col(seq))
    ranked = (
        df.withColumn("_day", day)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= passing + 1)
    )
    routed = ranked.withColumn(
        route, F.when(F.col("_rn") <= passing, F.lit("pass")).otherwise(F.lit("warn"))
    )
    return routed.drop("_rn")


def limiter_outputs(routed: DataFrame, keys: list[str], max_count: int, route: str = "route"):
    """(main, side) from one routed plan: passed rows and warning messages."""
    main = routed.where(F.col(route) == "pass").drop(route, "_day")
    side = routed.where(F.col(route) == "warn").select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.col("_day").alias("day"),
        F.lit(CLICK_WARNING.format(n=max_count)).alias("msg"),
    )
    return main, side


def limiter_counts(df: DataFrame, keys: list[str], ts_ms: str, max_count: int, inclusive_quirk: bool = True) -> DataFrame:
    """``route, n``: how many clicks the limiter passes, warns of and drops, from one scan.

    Only the number of a key's clicks in a day matters, so rows are counted with a
    map-side combine and never ranked.
    """
    passing = max_count + 1 if inclusive_quirk else max_count
    day = F.floor(F.col(ts_ms) / F.lit(DAY_MS)).cast("bigint")
    per_day = df.groupBy(*keys, day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    passed, over = F.least("_n", F.lit(passing)), F.greatest(F.col("_n") - F.lit(passing), F.lit(0))
    warned = F.least(over, F.lit(1))
    total = per_day.agg(*[
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(name)
        for name, n in (("pass", passed), ("warn", warned), ("drop", over - warned))
    ])
    return total.unpivot([], ["pass", "warn", "drop"], "route", "n")


def write_routes(
    routed: DataFrame, folder: str, routes: list[str], route: str = "route"
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """T2 in one pass: every route's rows written by one job, partitioned by route, and counted on the way.

    Returns each route's rows, read back from its part of ``folder``, and their
    numbers.  The counts come with the write (``observe``), so no output is
    computed or read a second time for them.  Rows of a route that is not in
    ``routes`` are an error.
    """
    known = F.when(F.col(route).isin(routes), F.col(route)).otherwise(
        F.raise_error(F.concat(F.lit("unknown route: "), F.coalesce(F.col(route), F.lit("null"))))
    )
    checked = routed.withColumn(route, known)
    counted = Observation()
    each = [F.count(F.when(F.col(route) == r, True)).alias(r) for r in routes]
    checked.observe(counted, *each).write.mode("overwrite").partitionBy(route).parquet(folder)
    spark = routed.sparkSession
    written = spark.read.schema(routed.schema).parquet(folder)
    return {r: written.where(F.col(route) == r).drop(route) for r in routes}, dict(counted.get)
