"""Extra columns, very long texts and bounded samples."""

import hashlib
import random

from pyspark.sql import functions as F

from eventide.llm import chat
from eventide.llm.common import least


def test_chat_with_extra_columns_and_very_long_texts(spark):
    """Columns of the log's own names beside the needed ones change nothing; texts of a million characters come back."""
    long = "a </s>\\ <|im_end|>\n" * 50_000
    rows = [(1, 0, "user", long, "x", 7, "k"), (1, 1, "assistant", long + "é", None, None, None), (2, 0, None, None, "y", 1, "k")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, at long, part string")
    plain = table.select("conv_id", "turn", "role", "text")
    got, want = [
        {r["conv_id"]: r for r in chat.digests(chat.render(chat.fold_events(chat.rows_as_events(t)))).collect()} for t in (table, plain)
    ]
    assert got == want
    assert got[1]["loss_chars"] == len(long) + 1
    assert got[1]["loss_sha256"] == hashlib.sha256((long + "é").encode()).hexdigest()
    assert (got[2]["n_turns"], got[2]["loss_chars"]) == (1, 0)


def test_the_least_rows_are_found_in_two_steps(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(-10**18, 10**18), rng.randrange(20)) for _ in range(3_000)]
    table = spark.createDataFrame(rows, "g string, h long, v long").withColumn("rank", F.struct("v", "h"))
    for most in (1, 7, 2_500):
        got = {(r["g"], r["v"], r["h"]) for r in least(table, "g", "rank", most, "h").collect()}
        want = set()
        for g in ("a", "b", None):
            want |= {(g, v, h) for v, h in sorted((v, h) for k, h, v in rows if k == g)[:most]}
        assert got == want
    assert least(table, "g", "h", 3, "h").count() == 9
