"""Delimited text and log-line parsers.

Each parser works on any DataFrame with a string column (``read.text``,
``readStream.text`` or a Kafka ``value``), so batch, stream and message
payloads share one JVM-side parser.  Lines that do not parse are kept, not
thrown: ``split_valid`` separates them into a reject DataFrame that carries
the raw line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_ms

# Field layouts.
USER_ACTION_FIELDS = [
    ("user_id", "string"),
    ("item_id", "string"),
    ("category_id", "string"),
    ("behavior", "string"),
    ("ts_s", "bigint"),
]
AD_CLICK_FIELDS = [
    ("user_id", "bigint"),
    ("ad_id", "bigint"),
    ("province", "string"),
    ("city", "string"),
    ("ts_s", "bigint"),
]
KEYED_LINE_FIELDS = [("key", "string"), ("ts_s", "bigint")]
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def parse_delimited(
    lines: DataFrame,
    fields: list[tuple[str, str]],
    sep: str = ",",
    value: str = "value",
) -> DataFrame:
    """Split ``value`` on the literal ``sep`` and cast into ``fields``.

    Adds ``_valid`` (enough fields and every cast succeeded; fields after the
    last one are ignored) and keeps the raw line as ``_raw``.  Casts use
    ``try_cast`` so ANSI mode never fails the job on a bad row.  A line is split
    once, whatever reads its fields (see ``_split_once``).
    """
    cols, ok = [], F.size("_parts") >= F.lit(len(fields))
    for i, (name, typ) in enumerate(fields):
        part = F.get("_parts", F.lit(i))
        c = part if typ == "string" else F.trim(part).try_cast(typ)
        cols.append(c.alias(name))
        ok = ok & c.isNotNull()
    return _split_once(lines, sep, value).select(*cols, F.coalesce(ok, F.lit(False)).alias("_valid"), "_raw")


def _split_once(lines: DataFrame, sep: str, value: str) -> DataFrame:
    """``_parts`` and ``_raw`` of each line.

    The array comes out of a generator, which Catalyst does not fold into the
    expressions above it; as a plain column it would be split anew for each
    field, test and filter.
    """
    split = F.split(F.col(value), _regex_literal(sep), -1)
    return lines.select(F.explode(F.array(split)).alias("_parts"), F.col(value).alias("_raw"))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$|?*+()[]{}\\" else ch for ch in sep)


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the bookkeeping columns, rejected raw lines)."""
    good = parsed.where(F.col("_valid")).drop("_valid", "_raw")
    bad = parsed.where(~F.col("_valid")).select(F.col("_raw").alias("line"))
    return good, bad


def with_event_time(df: DataFrame, seconds: str = "ts_s") -> DataFrame:
    """ts (TIMESTAMP) and ts_ms from an epoch-seconds column (seconds x 1000)."""
    ts = F.timestamp_seconds(F.col(seconds))
    return df.withColumn("ts", ts).withColumn("ts_ms", to_ms(ts))


def parsed_user_actions(lines: DataFrame, value: str = "value") -> DataFrame:
    """``user,item,category,behavior,seconds`` lines with ``_valid`` and ``_raw``: good and bad ones in one DataFrame."""
    return with_event_time(parse_delimited(lines, USER_ACTION_FIELDS, ",", value))


def user_actions(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """S1 as two DataFrames: user actions and rejected lines."""
    return split_valid(parsed_user_actions(lines, value))


def parsed_ad_clicks(lines: DataFrame, value: str = "value", ids_as_string: bool = False) -> DataFrame:
    """``user,ad,province,city,seconds`` lines (ids as bigint or string) with ``_valid`` and ``_raw``."""
    fields = AD_CLICK_FIELDS
    if ids_as_string:
        fields = [(n, "string" if n in ("user_id", "ad_id") else t) for n, t in fields]
    return with_event_time(parse_delimited(lines, fields, ",", value))


def ad_clicks(lines: DataFrame, value: str = "value", ids_as_string: bool = False):
    """S2 as two DataFrames: clicks and rejected lines."""
    return split_valid(parsed_ad_clicks(lines, value, ids_as_string))


def parsed_keyed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``key seconds`` lines, one space between, with ``_valid`` and ``_raw``."""
    return with_event_time(parse_delimited(lines, KEYED_LINE_FIELDS, " ", value))


def keyed_lines(lines: DataFrame, value: str = "value"):
    """S4 as two DataFrames: rows and rejected lines."""
    return split_valid(parsed_keyed_lines(lines, value))


def parsed_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """S3: space-split log line with ``_valid`` and ``_raw``; ip=f0, user=f2, time=f3, method=f5, url=f6.

    The time is ``dd/MM/yyyy:HH:mm:ss`` read in the session zone (UTC).
    """
    part = lambda i: F.get("_parts", F.lit(i))
    ts = F.try_to_timestamp(part(3), F.lit(ACCESS_LOG_TIME_FORMAT))
    return _split_once(lines, " ", value).select(
        part(0).alias("ip"), part(2).alias("user_id"), ts.alias("ts"), part(5).alias("method"), part(6).alias("url"),
        F.coalesce((F.size("_parts") >= 7) & ts.isNotNull(), F.lit(False)).alias("_valid"), "_raw",
    ).withColumn("ts_ms", to_ms(F.col("ts")))


def access_log(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """S3 as two DataFrames: requests and rejected lines."""
    return split_valid(parsed_access_log(lines, value))


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text lines from files (batch) or from a directory of new files (stream)."""
    reader = spark.readStream if stream else spark.read
    return reader.format("text").load(path)


def encode_delimited(df: DataFrame, cols: list[str], sep: str = ",") -> Column:
    """Inverse of ``parse_delimited``: one line per row; a null field is an empty one."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def encodable(cols: list[str], sep: str = ",") -> Column:
    """False for rows that a line can not carry: a field holds the separator or a line break."""
    fine = [F.coalesce(~F.col(c).cast("string").rlike(f"{_regex_literal(sep)}|[\\r\\n]"), F.lit(True)) for c in cols]
    return reduce(lambda a, b: a & b, fine)
