"""Message-bus and document connectors (S5-S7) and console output.

The Kafka connector JAR is not bundled; the reader and writer below are the
standard Structured Streaming calls and run wherever it is on the classpath.
Payload parsing and encoding are plain column functions from ``text.py`` and
are tested without a broker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import (
    USER_ACTION_FIELDS, encodable, encode_delimited, parse_delimited, split_valid, user_actions, with_event_time,
)


def kafka_user_actions(
    spark: SparkSession,
    servers: str,
    topic: str = "hotitems",
    group_id: str = "consumer-group",
    starting_offsets: str = "latest",
):
    """Stream of user actions from a topic (string payload, S1 parse).

    One stream of parsed rows with ``_valid`` and ``_raw``: a second reader of
    the topic under the same group would share its partitions.  Split good rows
    and rejects per micro-batch with ``valid_and_rejected``.
    """
    options = source_options(servers, topic, group_id, starting_offsets)
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_delimited(_as_lines(raw), USER_ACTION_FIELDS)


def source_options(servers: str, topic: str, group_id: str, starting_offsets: str = "latest") -> dict[str, str]:
    """What the bus reader is told."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": topic, "kafka.group.id": group_id, "startingOffsets": starting_offsets,
    }


def sink_options(servers: str, topic: str) -> dict[str, str]:
    """What the bus writer is told."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def _as_lines(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_payload(raw: DataFrame):
    """Kafka ``value`` bytes of a batch -> (user actions, rejected lines)."""
    return user_actions(_as_lines(raw))


def valid_and_rejected(
    good_sink: Callable[[DataFrame, int], None], reject_sink: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that feeds both outputs of a parsed stream from one read."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_valid(batch)
            good_sink(with_event_time(good), batch_id)
            reject_sink(bad, batch_id)
        finally:
            batch.unpersist()

    return run


def user_action_messages(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S6 encoder: (messages, rejects); one message per row, no key, value = the S1 line.

    The line format has no quoting, so a row with the separator or a line break
    in a field is rejected, not sent as a line that reads back as another row.
    """
    encoded = with_messages(actions)
    unsent = encoded.where(~F.col("_sendable")).select(*actions.columns)
    return encoded.where(F.col("_sendable")).select("value"), unsent


def with_messages(actions: DataFrame) -> DataFrame:
    """S6 encoder in one DataFrame: adds ``value``, the S1 line, and ``_sendable``."""
    cols = [n for n, _ in USER_ACTION_FIELDS]
    return actions.withColumns({"value": encode_delimited(actions, cols), "_sendable": encodable(cols)})


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write a batch of ``value`` rows to a topic (distributed, no driver loop)."""
    messages.select("value").write.format("kafka").options(**sink_options(servers, topic)).save()


def as_documents(df: DataFrame, col: str = "value") -> DataFrame:
    """S7 document body: ``{"data": <element>}`` per row."""
    return df.select(F.to_json(F.struct(F.col(col).alias("data"))).alias("doc"))


def document_sink(stream: DataFrame, path: str, checkpoint: str, col: str = "value"):
    """Documents written per micro-batch into ``path/batch=<id>``.

    Each batch overwrites its own folder, so a batch replayed after a failure
    replaces rather than duplicates its documents.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        as_documents(batch, col).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def print_sink(stream: DataFrame, path: str, checkpoint: str, prefix: str | None = None, output_mode: str = "append"):
    """Every element as a line of text, optionally prefixed like ``black list``.

    The executors write all rows of a micro-batch to ``path/batch=<id>``; a
    replayed batch replaces its own lines.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        printed_lines(batch, prefix).write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).outputMode(output_mode).option("checkpointLocation", checkpoint).start()
    )


def printed_lines(rows: DataFrame, prefix: str | None = None) -> DataFrame:
    body = F.to_json(F.struct(*rows.columns))
    return rows.select((body if prefix is None else F.concat(F.lit(prefix + "> "), body)).alias("value"))


def console_preview(stream: DataFrame, rows: int = 20):
    """A look at the first ``rows`` rows of each micro-batch, uncut; not an output of the whole stream."""
    return stream.writeStream.format("console").option("numRows", rows).option("truncate", False).start()
