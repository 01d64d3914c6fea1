"""Hot band keys are split into pairs of blocks, and no link is lost."""

import random

import pytest
from pyspark.sql import functions as F

from eventide.llm import components, simhash
from tests.llm.test_operators import components_of


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("block_prints", [simhash.BLOCK_PRINTS, 50, 3])
@pytest.mark.parametrize("radius", [1, 3])
def test_links_join_what_all_pairs_join(spark, block_prints, radius):
    """Half of all prints share two bands, and some families chain through small steps."""
    rng = random.Random(radius)
    base = rng.getrandbits(64)
    prints = {base ^ (rng.getrandbits(38) & rng.getrandbits(38) & rng.getrandbits(38)) for _ in range(250)}
    for p in list(prints)[:100]:
        for _ in range(rng.randint(0, 3)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    prints = sorted(map(signed, prints))
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.near_links(table, radius, block_prints)
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    mask = (1 << 64) - 1
    pairs = [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if ((a ^ b) & mask).bit_count() <= radius]
    want = components_of(pairs, {x for p in pairs for x in p})
    assert got == want and len(want) > 20


def test_a_hot_key_is_many_cells(spark):
    rng = random.Random(1)
    prints = [signed(rng.getrandbits(20)) for _ in range(900)] + [signed(rng.getrandbits(64)) for _ in range(900)]
    table = spark.createDataFrame([(p,) for p in set(prints)], "fp long")
    sized = simhash.cells(table, 3, 100).groupBy("t", "key", "i", "j").count()
    assert sized.agg(F.max("count")).first()[0] < 300  # two blocks, dealt by hash
    hot = sized.where("count > 100").groupBy("t", "key").count().orderBy(F.desc("count")).first()
    assert hot["count"] >= 36  # 9 blocks and more: all their pairs
    plain = simhash.cells(table, 3).agg(F.max("i"), F.max("side")).first()
    assert tuple(plain) == (0, 0)
