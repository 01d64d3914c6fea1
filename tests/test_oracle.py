"""Every registered query against its DuckDB oracle (sf0.001), plus whole-table
fingerprints at sf0.01 for the query too large to compare row by row."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from eventide.plans import jobs, oracle
from tests.conftest import SF0001, SF001
from tests.oracle_harness import compare, duck

NAMES = sorted(jobs.REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "rnk", "item_id", "cnt"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_a_fingerprint():
    missing = set(NAMES) - set(oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", [n for n in NAMES if n in oracle_sql() and n not in oracle.FINGERPRINT_ONLY])
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(queries()[name](spark, SF0001), oracle_sql()[name], SF0001, con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(oracle.FINGERPRINT_ONLY))
@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_large_query_fingerprint(spark, name, sf):
    """Row count and per-column checksums over the whole result, both engines."""
    from pyspark.sql import functions as F

    df = queries()[name](spark, sf)
    sql = oracle.FINGERPRINT_ONLY[name]
    con = duck(sf)
    cols = sorted(df.columns)
    checks = []
    for c in cols:
        t = dict(df.dtypes)[c]
        if t == "string":
            checks.append((F.sum(F.length(c)).alias(c), f"sum(length({c}))"))
            checks.append((F.sum(F.ascii(F.substring(c, -1, 1))).alias(c + "_last"),
                           f"sum(ascii(right({c}, 1)))"))
        else:
            checks.append((F.sum(F.col(c)).alias(c), f"sum({c})"))
    got = df.agg(F.count(F.lit(1)).alias("n"), *[x for x, _ in checks]).first()
    want = con.execute(
        f"SELECT count(*), {', '.join(y for _, y in checks)} FROM ({sql})"
    ).fetchone()
    assert int(got[0]) == int(want[0])
    for i, _ in enumerate(checks):
        assert int(got[i + 1]) == int(want[i + 1])
    # whole rows: sum of the first 32 bits of md5(row text), same in both engines
    row_text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    pair = df.agg(F.sum(F.conv(F.substring(F.md5(row_text), 1, 8), 16, 10).cast("bigint"))).first()[0]
    duck_text = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    want_pair = con.execute(
        f"SELECT sum(('0x' || substr(md5({duck_text}), 1, 8))::BIGINT) FROM ({sql})"
    ).fetchone()[0]
    assert int(pair) == int(want_pair)
