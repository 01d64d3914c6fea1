"""Exact deduplication by tree-merge of sorted digest runs.

Each Arrow batch of a partition becomes a sorted run of (digest, proof) with
the identifier that stays, the rows counted and the rows under that identifier.
Runs then move through a binomial tree of ``fan_in ** rounds`` leaves: in each
round the runs of ``fan_in`` neighbouring nodes meet, sorted by digest, and are
merged into one run per node, until a single node is left.  A node's run is
itself spread over all tasks by digest, so the root is no funnel; a
digest that a third of all rows share is one entry per run after the first
merge, so it is no hot key either.

The digest is SHA-256 of the text.  It is verified at every level by an
independent proof (MD5 and byte length): entries merge only when both agree, so
texts that merely collide in one digest stay apart.

Defined results: null text counts as empty; a null id stays only if its group
has no other; rows that repeat one id with equal text are counted one by one
and share their decision (``n_keep`` counts the rows under the id that stays); texts
of any length are digested whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed

RUN = "node int, digest binary, proof binary, keep_id long, n long, n_keep long"
_SCHEMA = pa.schema(
    [("node", pa.int32()), ("digest", pa.binary()), ("proof", pa.binary()),
     ("keep_id", pa.int64()), ("n", pa.int64()), ("n_keep", pa.int64())]
)


def _merged(rows: pa.Table, keep: str) -> pa.Table:
    """Entries of equal digest and proof become one; the result is sorted by digest."""
    keys = ["node", "digest", "proof"]
    best = rows.group_by(keys).aggregate([("keep_id", keep), ("n", "sum")])
    best = best.rename_columns({f"keep_id_{keep}": "keep_id", "n_sum": "n"})
    same = rows.join(best.select([*keys, "keep_id"]).rename_columns([*keys, "best"]), keys)
    under = pc.coalesce(pc.equal(same["keep_id"], same["best"]), pc.is_null(same["best"]))
    counted = same.filter(under).group_by(keys).aggregate([("n_keep", "sum")])
    out = best.join(counted.rename_columns({"n_keep_sum": "n_keep"}), keys)
    return out.select(_SCHEMA.names).sort_by([("node", "ascending"), ("digest", "ascending"), ("proof", "ascending")])


def _emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from table.cast(_SCHEMA).combine_chunks().to_batches()


def _first_runs(keep: str):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _emit(_merged(pa.Table.from_batches([batch]).cast(_SCHEMA), keep))

    return runs


def _merge_runs(keep: str):
    """Streams a partition sorted by (node, digest, proof); holds back the last entry of a batch."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).cast(_SCHEMA)
            done = _merged(table if rest is None else pa.concat_tables([rest, table]), keep)
            yield from _emit(done.slice(0, done.num_rows - 1))
            rest = done.slice(done.num_rows - 1)
        if rest is not None:
            yield from _emit(rest)

    return merge


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
    fan_in: int = 8, rounds: int = 2,
) -> DataFrame:
    """One row per distinct text: ``digest, proof, keep_id, n, n_keep``."""
    leaves = fan_in**rounds
    rows = _digests(docs, id_col, text_col).select(
        (F.spark_partition_id() % leaves).cast("int").alias("node"),
        "digest", "proof", F.col("_id").cast("long").alias("keep_id"),
        F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("n_keep"),
    )
    runs = rows.mapInArrow(_first_runs(keep), RUN)
    for _ in range(rounds):
        runs = (
            runs.withColumn("node", (F.col("node") / fan_in).cast("int"))
            .repartition("node", "digest")
            .sortWithinPartitions("node", "digest", "proof")
            .mapInArrow(_merge_runs(keep), RUN)
        )
    return runs.select("digest", "proof", "keep_id", "n", "n_keep")


def _digests(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.unhex(F.concat(F.md5(text), F.lpad(F.hex(F.octet_length(text)), 16, "0"))).alias("proof"),
        *more,
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", **tree
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256, n_keep``."""
    groups = duplicate_groups(docs, id_col, text_col, keep, **tree)
    return _digests(docs, id_col, text_col).join(groups, ["digest", "proof"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_keep",
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max", **tree
) -> DataFrame:
    """``docs`` with one row of each distinct text, all columns as they were."""
    groups = duplicate_groups(docs, id_col, text_col, keep, **tree)
    whole = packed(docs, F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    stay = _digests(whole, "_key", "_text", "_row").join(
        groups.select("digest", "proof", "keep_id", "n_keep"), ["digest", "proof"]
    ).where(F.col("_id").eqNullSafe(F.col("keep_id")))
    # rows repeated under one id: only those need a shuffle to leave one
    once = stay.where("n_keep = 1").select("_row.*")
    again = stay.where("n_keep > 1").dropDuplicates(["digest", "proof"]).select("_row.*")
    return once.unionByName(again)
