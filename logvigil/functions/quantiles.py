"""Exact percentiles of large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL_GROUP = 2000
MARGIN = 0.002
ACCURACY = 10_000


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, out: str, few_groups: bool = False) -> DataFrame:
    """(keys, ``out``): the exact percentile (linear interpolation) of each group's non-null values.

    The built-in exact percentile keeps a group's distinct values in one buffer. Here a mergeable
    sketch brackets the percentile first; then only values inside the bracket (0.4% of a large
    group) are counted one by one, the ones below just as a number. The bracket is wider than the
    sketch's error bound, and groups up to SMALL_GROUP rows are bracketed by their range. ``few_groups`` promises
    that one row per group fits a broadcast.
    """
    x = F.col(value)
    sketch = F.percentile_approx(x, F.array(F.lit(max(p - MARGIN, 0.0)), F.lit(min(p + MARGIN, 1.0))), F.lit(ACCURACY))
    spans = df.groupBy(*keys).agg(F.count(x).alias("_n"), F.min(x).alias("_min"), F.max(x).alias("_max"), sketch.alias("_q"))
    small = F.col("_n") <= SMALL_GROUP
    spans = spans.select(
        *keys, "_n",
        F.when(small, F.col("_min")).otherwise(F.get("_q", F.lit(0))).alias("_lo"),
        F.when(small, F.col("_max")).otherwise(F.get("_q", F.lit(1))).alias("_hi"),
    )
    near = df.join(F.broadcast(spans) if few_groups else spans, keys).filter(x <= F.col("_hi"))
    cells = near.groupBy(*keys, "_n", F.when(x >= F.col("_lo"), x).alias("_v")).agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_cum", F.sum("_c").over(upto)).filter(F.col("_v").isNotNull())
    pos = F.lit(p) * (F.col("_n") - 1)
    at = F.floor(pos)
    picked = cells.groupBy(*keys, "_n").agg(
        F.min(F.when(F.col("_cum") > at, F.col("_v"))).alias("_low"),
        F.min(F.when(F.col("_cum") > at + 1, F.col("_v"))).alias("_high"),
    )
    low = F.col("_low")
    return picked.select(*keys, (low + (pos - at) * (F.coalesce("_high", low) - low)).alias(out))
