"""Mixing sources to target weights.

Words are summed for each source, targets are shared out by weight up to a limit of repetition, and each document is
emitted floor(rate) times plus one copy that a keyed hash of its id and text grants with the probability of the fraction.
No step depends on the order or the number of rows of a source: a hot source is only summed (map side first) and
its rows are never brought together.

Null text has size 0. Null is a source of its own, ranked last. Documents that share an id, or have none, draw by their
texts; rows that agree in both share one draw. An empty table gives an empty mix; sources without words get target 0 and no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, word_count

#: Sources up to this number are joined by broadcast (under 10 MB), more by a shuffled join.
BROADCAST_SOURCES = 100_000


def ranked_sources(sizes: DataFrame, parts: int = 32) -> DataFrame:
    """Adds ``rank`` (from 0, code-point order, null last) without bringing the sources into one task."""
    placed = sizes.withColumn("last", F.col("source").isNull()).repartitionByRange(parts, "last", "source").sortWithinPartitions("last", "source")
    placed = stored(placed.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))  # at most one row a range
    return placed.join(F.broadcast(starts), "part").select("source", "source_size", (F.col("place") + F.col("start")).alias("rank"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size).

    ``weights`` repeat over the ranked sources and share ``share`` times all words; a target above ``limit`` times its
    source's words stays there and the rest is shared again until no target is above. Each round is one aggregation
    with two numbers as its result.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    s = stored(ranked_sources(sizes).select("source", "source_size", F.get(cycle, (F.col("rank") % len(weights)).cast("int")).alias("weight"), (F.col("source_size") * limit).alias("most")), "weights")
    budget = share * (s.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        at = F.lit(level) * F.col("weight") >= F.col("most")
        got = s.agg(F.sum(F.when(at, F.col("most")).otherwise(0.0)), F.sum(F.when(at, 0).otherwise(F.col("weight"))), F.count_if(at)).first()
        if got[2] == full or not got[1]:
            break
        full, level = got[2], (budget - got[0]) / got[1]
    target = F.least(F.col("most"), F.lit(level) * F.col("weight")).cast("double")
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return s.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def text_mark(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.md5(F.coalesce(col, F.lit("")))


def draw(doc_id: Column, mark: Column, seed: str) -> Column:
    """A number in [0, 1) from the id, the text's mark and the seed: 52 bits of MD5, which SQL engines share."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), mark)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def copies(docs: DataFrame, rates: DataFrame, seed: str = "mix", id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` in place of any columns of these names. ``_mark`` is the text's mark."""
    r = rates.select(F.col("source").alias("_mix_source"), "source_size", "target", F.col("rate").alias("_mix_rate"))
    if r.count() <= BROADCAST_SOURCES:
        r = F.broadcast(r)
    kept = docs.drop("source_size", "target", "copies")
    whole = F.floor("_mix_rate")
    extra = (draw(kept[id_col], kept["_mark"], seed) < F.col("_mix_rate") - whole).cast("int")
    joined = kept.join(r, kept[source_col].eqNullSafe(r["_mix_source"]))
    return joined.withColumn("copies", (whole + extra).cast("int")).drop("_mix_source", "_mix_rate", "_mark")


def source_sizes(docs: DataFrame, size: Column, source_col: str = "source") -> DataFrame:
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"))


def mix(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as its source's rate asks; the columns of ``docs`` only."""
    marked = copies(docs.select(F.struct("*").alias("_mix_row"), "doc_id", "source", text_mark("text").alias("_mark")), targets(source_sizes(docs, word_count("text")), **how), seed)
    return marked.filter("copies > 0").select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_mix_row.*")


def mix_report(docs: DataFrame, seed: str = "mix", **how) -> DataFrame:
    """doc_id, size, source_size, target, taken: what ``mix`` takes of each document."""
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size"), text_mark("text").alias("_mark")), "sizes")
    marked = copies(sized, targets(source_sizes(sized, F.col("size")), **how), seed)
    return marked.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


MIX_SQL = r"""with s as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size, md5(coalesce(text, '')) as mark from documents),
g as (select source, cast(sum(size) as bigint) as source_size from s group by source),
w as (select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint)] as weight from g),
c as (select *, 2.0::double * source_size as most, 2.0::double * source_size / weight as ratio from w),
o as (select *, coalesce(sum(most) over (order by ratio, weight, source nulls last rows between unbounded preceding and 1 preceding), 0) as done,
 sum(weight) over (order by ratio, weight, source nulls last rows between current row and unbounded following) as rest from c),
l as (select (1.5::double * (select sum(source_size) from g) - done) / rest as level, ratio from o),
v as (select level from l where level <= ratio order by ratio, level limit 1),
t as (select source, source_size, least(most, level * weight)::double as target from c, v),
r as (select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from t)
select doc_id, size, source_size, target, cast(size * (floor(rate) + case when ('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || mark), 1, 13))::bigint / 4503599627370496.0::double < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from s join r on s.source is not distinct from r.source"""
