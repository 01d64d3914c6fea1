"""Aggregates that a caller defines by four functions: create, add, merge, result.

Spark's built-in aggregates run in two phases; so does a user's: ``add`` folds
the rows of a batch into one accumulator per group before the exchange, and
``merge`` folds accumulators behind it.  A hot group ships one accumulator per
batch and task, not its rows.  Behind the exchange the accumulators come sorted
by group (Spark spills the sort), so a task holds one group's accumulator at a
time, however many groups it has.

``add`` is given whole Arrow columns, not rows, so it can work on vectors.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..session import ship_package


@dataclass(frozen=True)
class Mergeable:
    """A user-defined aggregate.

    ``create()`` gives an empty accumulator, ``add(acc, *columns)`` one that also
    holds the rows of the columns (numpy arrays, one per input), ``merge(a, b)`` the
    accumulator of both, ``result(acc)`` its value, of the SQL type ``returns``.
    ``merge`` must not depend on the order of its operands or of the merges.
    Accumulators are pickled between the phases.
    """

    create: Callable[[], Any]
    add: Callable[..., Any]
    merge: Callable[[Any, Any], Any]
    result: Callable[[Any], Any]
    returns: str


def _groups(columns: list[pa.Array]) -> Iterator[tuple[int, np.ndarray]]:
    """First row and rows of each distinct combination of values; nulls are equal to each other."""
    codes = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        encoded = column.dictionary_encode(null_encoding="encode")
        named = np.unique(codes * (len(encoded.dictionary) + 1) + encoded.indices.to_numpy(zero_copy_only=False), return_inverse=True)
        codes = named[1].astype(np.int64)
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    for rows in np.split(order, starts[1:]) if len(order) else []:
        yield int(rows[0]), rows


def aggregate(df: DataFrame, keys: list[str], inputs: list[str], agg: Mergeable, out: str) -> DataFrame:
    """``keys, <out>``: ``agg`` over the ``inputs`` of each group; rows with a null input are not added.

    Groups whose rows are all null have the result of an empty accumulator.
    """
    ship_package(df.sparkSession)
    names = [f"k{i}" for i in range(len(keys))] + [f"v{i}" for i in range(len(inputs))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip([*keys, *inputs], names)])
    key_fields = [StructField(f"k{i}", rows.schema[f"k{i}"].dataType) for i in range(len(keys))]
    partial = StructType([*key_fields, StructField("acc", BinaryType())])

    def add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.columns
            group_keys = columns[: len(keys)] or [pa.array(np.zeros(batch.num_rows, dtype=np.int64))]
            values = columns[len(keys):]
            full = np.ones(batch.num_rows, dtype=bool)
            for v in values:
                full &= v.is_valid().to_numpy(zero_copy_only=False)
            arrays = [v.to_numpy(zero_copy_only=False) for v in values]
            first, accs = [], []
            for at, members in _groups(group_keys):
                members = members[full[members]]
                acc = agg.create()
                accs.append(pickle.dumps(agg.add(acc, *[a[members] for a in arrays]) if len(members) else acc))
                first.append(at)
            kept = [c.take(pa.array(first)) for c in columns[: len(keys)]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(accs, pa.binary())], names=[*names[: len(keys)], "acc"])

    merged_names = [f"k{i}" for i in range(len(keys))]

    def merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Accumulators come sorted by group; one is held, and written when the next group begins."""
        group, held, empty = None, None, True
        for batch in batches:
            keys_of = list(zip(*[c.to_pylist() for c in batch.columns[:-1]])) or [()] * batch.num_rows
            done = []
            for key, data in zip(keys_of, batch.column(batch.num_columns - 1).to_pylist()):
                key, acc = tuple(map(_comparable, key)), (key, pickle.loads(data))
                if not empty and key == group:
                    held = (held[0], agg.merge(held[1], acc[1]))
                    continue
                if not empty:
                    done.append(held)
                group, held, empty = key, acc, False
            if done:
                yield _results(done)
        if not empty:
            yield _results([held])

    fields = StructType([*key_fields, *StructType.fromDDL(f"result {agg.returns}").fields])
    arrow_schema = _arrow(fields)

    def _results(done: list) -> pa.RecordBatch:
        rows = [dict(zip(merged_names, key)) | {"result": agg.result(acc)} for key, acc in done]
        return pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    accs = rows.mapInArrow(add_rows, partial)
    spread = accs.repartition(*merged_names) if keys else accs.coalesce(1)
    merged = spread.sortWithinPartitions(*merged_names) if keys else spread
    found = merged.mapInArrow(merge_rows, fields)
    return found.select(*[F.col(n).alias(c) for n, c in zip(merged_names, keys)], F.col("result").alias(out))


def _comparable(value):
    """NaN keys are one group, as in Spark."""
    return "NaN" if isinstance(value, float) and value != value else value


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# ------------------------------------------------------------------ an aggregate


def histogram_quantiles(width: float, probabilities: list[float]) -> Mergeable:
    """Quantiles of a number column from counts per bin of ``width``: a mergeable sketch.

    The accumulator maps bin numbers to counts, so its size is bounded by the range
    of the values over the width, not by their number, and merges are exact.  A
    quantile is the number of the first bin in which the running count reaches its share
    (``ceil(p * n)`` values, at least one); null for no values.
    """

    def add(acc: dict, values: np.ndarray) -> dict:
        bins, counts = np.unique(np.floor(values.astype(np.float64) / width).astype(np.int64), return_counts=True)
        return merge(acc, dict(zip(bins.tolist(), counts.tolist())))

    def merge(a: dict, b: dict) -> dict:
        if len(a) < len(b):
            a, b = b, a
        for k, n in b.items():
            a[k] = a.get(k, 0) + n
        return a

    def result(acc: dict) -> list[int] | None:
        if not acc:
            return None
        bins = np.array(sorted(acc), dtype=np.int64)
        reached = np.cumsum([acc[b] for b in bins.tolist()])
        wanted = [max(1, math.ceil(round(p * int(reached[-1]), 9))) for p in probabilities]
        return bins[np.searchsorted(reached, wanted)].tolist()

    return Mergeable(dict, add, merge, result, "array<bigint>")
