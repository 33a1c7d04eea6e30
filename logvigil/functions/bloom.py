"""Bloom filters as column expressions: prune a large side by a small one before anything is shuffled."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 4 << 20  # 3.3 million keys at 10 bits
BITS_PER_KEY = 10
PROBES = 4


def _positions(columns: list[Column], bits: int) -> list[Column]:
    """Double hashing on the two halves of one 64-bit hash; nulls are skipped by the hash, so null keys agree as well."""
    h = F.xxhash64(*columns)
    first, step = h.bitwiseAND(F.lit(0x7FFFFFFF).cast("bigint")), F.shiftrightunsigned(h, 33)
    return [(first + F.lit(i).cast("bigint") * step).bitwiseAND(F.lit(bits - 1).cast("bigint")) for i in range(PROBES)]


def build_filter(keys: DataFrame, n: int, max_bytes: int = MAX_BYTES) -> Callable[[list[Column]], Column] | None:
    """A test that every row of ``keys`` passes and about one in a hundred others; None if ``n`` keys would need more than
    ``max_bytes``. The bits are set by a distributed aggregation; one row for each 64 bits is collected."""
    bits = 64
    while bits < n * BITS_PER_KEY:
        bits *= 2
    if bits > 8 * max_bytes:
        return None
    at = keys.select(F.explode(F.array(*_positions([F.col(f"`{c}`") for c in keys.columns], bits))).alias("at"))
    cells = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("b"))
    words = [0] * (bits // 64)
    for r in cells.collect():
        words[r.w] = r.b
    literal = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")  # folded to one literal of the plan

    def test(columns: list[Column]) -> Column:
        hit = lambda p: F.getbit(F.get(literal, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1
        return reduce(Column.__and__, map(hit, _positions(columns, bits)))

    return test
