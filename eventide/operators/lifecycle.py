"""Per-partition set-up and clean-up around a batch transform.

The reference's rich flat-map opens a resource once per parallel instance,
maps each element, and closes the resource at the end.  On Spark the same
shape is a ``mapInPandas`` generator: set-up before the first Arrow batch of
a task, the transform per batch, clean-up in ``finally`` (also on failure).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package


def map_with_lifecycle(
    df: DataFrame,
    transform: Callable[[pd.DataFrame, Any], pd.DataFrame],
    schema: str,
    setup: Callable[[], Any] | None = None,
    teardown: Callable[[Any], None] | None = None,
) -> DataFrame:
    """``transform(batch, resource)`` per Arrow batch; ``setup``/``teardown`` once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup() if setup else None
        try:
            for pdf in batches:
                out = transform(pdf, resource)
                if len(out):
                    yield out
        finally:
            if teardown:
                teardown(resource)

    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)


def ints_to_strings(df: DataFrame, col: str = "value") -> DataFrame:
    """The data work of the reference's Int -> String flat map: a JVM cast."""
    return df.select(F.col(col).cast("string").alias(col))
