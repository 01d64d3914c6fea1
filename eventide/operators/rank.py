"""Top-N per window (K1) and the ranked text report (K2).

``row_number() <= N`` over ``partitionBy(window_end)`` is planned by Catalyst
as a ``WindowGroupLimit``: a partial top-N runs on every map partition before
the exchange, so the shuffle carries at most N rows per window and partition,
however many keys a window holds.  Ties are broken by key ascending.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import timestamp_text


def top_n(
    df: DataFrame,
    group: list[str],
    score: str,
    key: str,
    n: int,
    rank: str = "rnk",
) -> DataFrame:
    """Keep the ``n`` highest ``score`` rows per ``group``; adds ``rank`` 1..n."""
    w = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(key).asc())
    limited = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
    return limited.withColumn(rank, F.col(rank).cast("bigint"))


# The report layout (rule line, time label, item and url labels).
REPORT_RULE = "===================================="
TIME_LABEL = "时间: "
ITEM_LABELS = ("  商品ID=", "  浏览量=")
URL_LABELS = ("  URL=", "  流量=")


def ranked_report(
    ranked: DataFrame,
    window_end: str,
    key: str,
    score: str,
    rank: str = "rnk",
    labels: tuple[str, str] = ITEM_LABELS,
    out: str = "report",
) -> DataFrame:
    """One text block per window from the top-N rows (at most N per group).

    Layout: rule line, ``时间: <window_end>``, ``No{i}:<key label><key>
    <count label><count>`` per rank, closing rule line and a blank line.
    """
    line = F.concat(
        F.lit("No"),
        F.col(rank).cast("string"),
        F.lit(":"),
        F.lit(labels[0]),
        F.col(key).cast("string"),
        F.lit(labels[1]),
        F.col(score).cast("string"),
        F.lit("\n"),
    )
    grouped = ranked.groupBy(window_end).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank), line.alias("line")))).alias("_lines")
    )
    body = F.array_join(F.transform("_lines", lambda s: s["line"]), "")
    text = F.concat(
        F.lit(REPORT_RULE + "\n" + TIME_LABEL),
        timestamp_text(F.col(window_end)),
        F.lit("\n"),
        body,
        F.lit(REPORT_RULE + "\n\n"),
    )
    return grouped.select(window_end, text.alias(out))
