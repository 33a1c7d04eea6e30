"""Ordered per-key work that stays balanced when a few keys hold most of the rows.

A window partitioned by key runs each key in one task. That is the best plan while every key is
of moderate size, so the operators measure first (one pre-aggregated count over the key column)
and only keys above ``hot_rows`` take the split route:

1. ``sequenced`` numbers the rows of a key exactly without gathering them: rows are counted per
   (key, second), the counts are summed up to offsets, and each row is numbered inside its second.
2. ``rolling`` cuts a numbered key into chunks of equal length. The last ``halo`` rows of a chunk
   are copied to the next one, so a frame that looks back at most ``halo`` rows sees all it needs;
   copies are dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fields import clock_seconds

HOT_ROWS = 2_000_000


def hot_limit(df: DataFrame, hot_rows: int | None) -> int:
    return int(hot_rows or df.sparkSession.conf.get("spark.logvigil.hotRows", str(HOT_ROWS)))


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows as a small table, or None.

    There are fewer than (all rows / hot_rows) of them, which bounds what is collected here and
    what is broadcast later.
    """
    limit = hot_limit(df, hot_rows)
    found = df.groupBy(*keys).count().filter(F.col("count") > limit).drop("count")
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def running_totals(df: DataFrame, keys: list[str], pos: str, cols: list[str], block: int) -> DataFrame:
    """Adds ``<col>_before``: the sum of ``col`` over rows of the key at smaller integer positions.

    One row per (key, position). Sums run inside blocks of positions and over the block totals, so
    no task walks more than one block of a key or one row per block.
    """
    before = lambda part, order: Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    e = df.withColumn("_block", F.expr(f"({pos} - pmod({pos}, {block})) div {block}"))
    blocks = e.groupBy(*keys, "_block").agg(*[F.sum(c).alias(c) for c in cols])
    blocks = blocks.select(*keys, "_block", *[F.coalesce(F.sum(c).over(before(keys, "_block")), F.lit(0)).alias(f"_o_{c}") for c in cols])
    inside = {f"{c}_before": F.coalesce(F.sum(c).over(before([*keys, "_block"], pos)), F.lit(0)) for c in cols}
    out = null_safe_join(e.withColumns(inside), blocks, [*keys, "_block"])
    return out.select(*df.columns, *[(F.col(f"{c}_before") + F.col(f"_o_{c}")).alias(f"{c}_before") for c in cols])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the keys come from ``left``."""
    names = {k: f"_r_{k}" for k in keys}
    other = right.withColumnsRenamed(names)
    cond = left[keys[0]].eqNullSafe(other[names[keys[0]]])
    for k in keys[1:]:
        cond = cond & left[k].eqNullSafe(other[names[k]])
    out = left.join(other, cond, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*names.values())


_NO_TIME = -(2**40)  # rows without a time come first, as nulls do in a window order


def sequenced(df: DataFrame, keys: list[str], ts: str, tie: str, seq: str = "seq") -> DataFrame:
    """Exact row number per key in (ts, tie) order with no task larger than one second of a key.

    With ``keys=[]`` it numbers the whole table.
    """
    e = df.withColumn("_cell", F.coalesce(clock_seconds(F.col(ts)), F.lit(_NO_TIME)))
    cells = e.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    offsets = running_totals(cells, keys, "_cell", ["_n"], block=86_400).select(*keys, "_cell", "_n_before")
    local = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(ts, tie))
    return (
        e.withColumn("_rn", local)
        .transform(lambda d: null_safe_join(d, offsets, [*keys, "_cell"]))
        .withColumn(seq, (F.col("_rn") + F.col("_n_before")).cast("bigint"))
        .select(*df.columns, seq)
    )


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys). ``hot`` is bounded, see ``hot_keys``; null is a key like any other."""
    if hot is None:
        return df, None
    return null_safe_join(df, F.broadcast(hot), keys, "left_anti"), null_safe_join(df, F.broadcast(hot), keys, "left_semi")


def numbered(df: DataFrame, key: str, ts: str, tie: str, seq: str = "seq", hot_rows: int | None = None) -> DataFrame:
    """Row number per key, by window for ordinary keys and by ``sequenced`` for hot ones."""
    cold, hot = split_hot(df, [key], hot_keys(df, [key], hot_rows))
    out = cold.withColumn(seq, F.row_number().over(Window.partitionBy(key).orderBy(ts, tie)).cast("bigint"))
    return out if hot is None else out.unionByName(sequenced(hot, [key], ts, tie, seq))


def rolling(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    halo: int,
    build: Callable[[DataFrame, list[str]], DataFrame],
    hot_rows: int | None = None,
    build_hot: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    seq: str = "seq",
    has_seq: bool = False,
) -> DataFrame:
    """Apply ``build(frame, partition_columns)`` where each frame row has its number in ``seq``
    (``has_seq``: the input already carries it).

    ``build`` adds columns from windows ordered by ``seq`` that look back at most ``halo`` rows.
    ``build_hot`` replaces it on chunks of hot keys, for values a chunk cannot see by itself.
    """
    limit = hot_limit(df, hot_rows)
    cold, hot = split_hot(df, [key], hot_keys(df, [key], limit))
    order = Window.partitionBy(key).orderBy(ts, tie)
    out = build(cold if has_seq else cold.withColumn(seq, F.row_number().over(order).cast("bigint")), [key])
    if hot is None:
        return out
    length = max(limit, halo + 1)
    home = F.expr(f"({seq} - 1) div {length}")
    is_tail = ((F.col(seq) - 1) % length) >= length - halo
    chunked = (
        (hot if has_seq else sequenced(hot, [key], ts, tie, seq))
        .withColumn("_home", home)
        .withColumn("_chunk", F.explode(F.when(is_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    )
    done = (build_hot or build)(chunked, [key, "_chunk"]).filter(F.col("_home") == F.col("_chunk"))
    return out.unionByName(done.drop("_home", "_chunk"))


def range_counts(
    df: DataFrame, keys: list[str], clock: str, seconds: int, out: str, hot_rows: int | None = None
) -> DataFrame:
    """Rows of the same key in the ``seconds`` up to and including this row's second.

    Ordinary keys use a range frame. Rows of hot keys are first counted per (key, second), so the
    ordered part holds at most one row per second, and the count is joined back.
    """
    order = Window.partitionBy(*keys).orderBy(clock).rangeBetween(-seconds, Window.currentRow)
    cold, hot = split_hot(df, keys, hot_keys(df, keys, hot_rows))
    done = cold.withColumn(out, F.count("*").over(order))
    if hot is None:
        return done
    slots = hot.groupBy(*keys, clock).agg(F.count("*").alias("_n"))
    slots = slots.withColumn(out, F.sum("_n").over(order)).drop("_n")
    return done.unionByName(null_safe_join(hot, slots, [*keys, clock]).select(*done.columns))


def range_sums(df: DataFrame, keys: list[str], clock: str, wanted: dict[str, tuple[str, int]], hot_rows: int | None = None) -> DataFrame:
    """``range_counts`` for several flags and lengths at once: column ``out`` of ``wanted`` {out: (flag, seconds)} is the number of
    rows with the boolean ``flag``. All frames share one exchange and one sort, for hot keys one count per (key, second)."""
    frame = lambda seconds: Window.partitionBy(*keys).orderBy(clock).rangeBetween(-seconds, Window.currentRow)
    cold, hot = split_hot(df, keys, hot_keys(df, keys, hot_rows))
    done = cold.withColumns({out: F.sum(F.col(flag).cast("bigint")).over(frame(s)) for out, (flag, s) in wanted.items()})
    if hot is None:
        return done
    flags = sorted({flag for flag, _ in wanted.values()})
    slots = hot.groupBy(*keys, clock).agg(*[F.sum(F.col(f).cast("bigint")).alias(f"_n{f}") for f in flags])
    slots = slots.select(*keys, clock, *[F.sum(f"_n{flag}").over(frame(s)).alias(out) for out, (flag, s) in wanted.items()])
    return done.unionByName(null_safe_join(hot, slots, [*keys, clock]).select(*done.columns))


def lit_map(values: dict) -> Column:
    """A map literal from a small fixed table."""
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
