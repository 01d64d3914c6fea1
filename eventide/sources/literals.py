"""In-memory literal inputs (S8) used by the reference's examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The example inputs.
LOGINS = [
    ("1", "192.168.0.1", "fail", "1558430842"),
    ("1", "192.168.0.2", "fail", "1558430844"),
    ("1", "192.168.0.3", "fail", "1558430845"),
    ("4", "192.168.0.1", "success", "1558430846"),
]
GATE_CONTROLS = [("sensor_2", 2000), ("sensor_7", 7000)]
INTS = [1, 2, 3, 4]
INT_PAIRS = [(1, 1), (2, 2), (3, 3)]
STRINGS = ["a", "b"]


def logins(spark: SparkSession) -> DataFrame:
    """Login events; ``ts`` is a seconds string as in the source, plus ts_ms/seq."""
    rows = [(i, *row) for i, row in enumerate(LOGINS)]
    df = spark.createDataFrame(rows, "seq bigint, user_id string, ip string, status string, ts_s string")
    return df.withColumn("ts_ms", F.col("ts_s").cast("bigint") * 1000)


def gate_controls(spark: SparkSession, at_ms: int = 0) -> DataFrame:
    df = spark.createDataFrame(GATE_CONTROLS, "id string, duration_ms bigint")
    return df.withColumn("ts_ms", F.lit(at_ms).cast("bigint"))


def ints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v,) for v in INTS], "value int")


def int_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INT_PAIRS, "a int, b int")


def strings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v,) for v in STRINGS], "value string")
