"""Registered queries of the subpackage against DuckDB SQL on the given tables."""

import pytest

from eventide.llm import oracle, pieces, queries, token_counts
from tests.conftest import SF001, SF0001
from tests.oracle_harness import compare, duck


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_oracle(spark, name):
    ok, said = compare(queries.REGISTRY[name](spark, SF001), oracle.ORACLE[name], SF001, duck(SF001))
    assert ok, said


def test_token_counts_query(spark):
    """The registered query against counting each text by itself."""
    docs = {r["doc_id"]: r["text"] for r in queries.read_table(spark, SF0001, "documents").collect()}
    rows = queries.op4_token_counts(spark, SF0001).collect()
    assert len(rows) == len(docs)
    vocabulary = pieces.load()
    for r in rows[:60]:
        alone = token_counts.count_texts([docs[r["doc_id"]]], vocabulary).iloc[0]
        assert (r["n_chunks"], r["n_tokens"]) == (alone["n_chunks"], alone["n_tokens"])


def test_sentencepiece_query(spark):
    """All texts decode; costs rise; the best segmentation has as many pieces as op4 counts where costs do not tie."""
    rows = queries.op6_sentencepiece(spark, SF0001).collect()
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.op4_token_counts(spark, SF0001).collect()}
    assert len(rows) == len(counts)
    for r in rows:
        assert r["restored"] and list(r["costs"]) == sorted(r["costs"]) and r["n_pieces"] == len(r["ids"])
        assert r["n_pieces"] == counts[r["doc_id"]]
