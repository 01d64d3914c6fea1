"""Polynomial string hash used to place users in a bitmap (P10).

The rule: ``h = h * 61 + code(char)`` over the characters, kept as a 32-bit
integer, and the bit index is the low 29 bits of ``h``.  Low bits of a product
and sum depend only on the low bits of the operands, so folding modulo 2^29
gives the same index without 32-bit overflow emulation and without a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier 61, bitmap of 2^29 bits.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def poly_hash(s: Column | str, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> Column:
    """Bit index of a string in a ``bits``-wide map (JVM-side higher-order fold)."""
    s = F.col(s) if isinstance(s, str) else s
    codes = F.transform(F.split(s, ""), lambda c: F.ascii(c).cast("bigint"))
    # split(s, '') yields [''] for the empty string; ascii('') = 0 leaves h at 0.
    return F.aggregate(
        codes,
        F.lit(0).cast("bigint"),
        lambda acc, c: F.pmod(acc * F.lit(seed) + c, F.lit(bits)),
    )
