"""Readers for the parquet tables and the event model derived from them.

``events`` carries ``ts`` as TIMESTAMP_NTZ; it is cast once to TIMESTAMP (UTC
session) because event-time streaming operators reject NTZ columns.  The
derived columns follow the mapping in SURVEY section 5:

    item_id   <- props.k            (hot items, ads, pages)
    channel   <- props.k % 6        (marketing channel / province)
    ts_ms     <- epoch milliseconds of ts
    seq       <- event_id           (arrival order, unique tie-break)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_ms
from ..session import ensure_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def item_of(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``events`` table in the engine's event model."""
    ensure_session(spark)
    raw = read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return raw.select(
        "event_id",
        ts.alias("ts"),
        to_ms(ts).alias("ts_ms"),
        "user_id",
        "event_type",
        "value",
        item_of().alias("item_id"),
        F.col("event_id").alias("seq"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")
