"""Peer groups: entity vectors, clustering, group statistics and the peer score."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.quantiles import exact_percentile
from ..functions.skew import running_totals, sequenced
from ..session import materialize
from .profile import recent_rows


def entity_vector(df: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity", ts: str = "ts", tie: str = "event_id", min_rows: int = C.MIN_VECTOR_ROWS) -> DataFrame:
    """mean, deviation and maximum of each feature over the entity's last rows, one row per entity."""
    recent = recent_rows(df, C.RECENT_ROWS, key, ts, tie)
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        x = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
        for name, agg in (("mean", F.avg), ("std", F.stddev_pop), ("max", F.max)):
            aggs.append(F.coalesce(agg(x), F.lit(0.0)).alias(f"{name}_{f}"))
    return recent.groupBy(key).agg(F.count("*").alias("recent_rows"), *aggs).filter(F.col("recent_rows") >= min_rows)


def group_count(n: Column) -> Column:
    """Number of groups for ``n`` eligible entities."""
    return F.least(F.greatest(F.lit(3), F.floor(n / 10)), F.lit(C.MAX_GROUPS)).cast("int")


def peer_groups(vectors: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity", standardize: bool = False, seed: int = C.PEER_SEED) -> DataFrame | None:
    """Cluster entities into groups; None below the minimum number of entities.

    Vectors are clustered unscaled by default; ``standardize=True`` gives every dimension unit
    deviation. Group numbers carry no meaning.
    """
    names = [f"{a}_{f}" for f in features for a in ("mean", "std", "max")]
    n = vectors.count()
    if n < C.MIN_GROUP_SIZE:
        return None
    k = min(max(3, n // 10), C.MAX_GROUPS)
    data = vectors.select(key, array_to_vector(F.array(*[F.col(c).cast("double") for c in names])).alias("raw"))
    if standardize:
        from pyspark.ml.feature import StandardScaler

        data = StandardScaler(inputCol="raw", outputCol="vector", withMean=True).fit(data).transform(data)
    else:
        data = data.withColumnRenamed("raw", "vector")
    model = KMeans(k=k, seed=seed, maxIter=C.PEER_ITERATIONS, featuresCol="vector", predictionCol="group_id").fit(data)
    return model.transform(data).select(key, "group_id")


def with_group_size(assignments: DataFrame, key: str = "entity") -> DataFrame:
    sizes = assignments.groupBy("group_id").agg(F.count("*").cast("int").alias("group_size"))
    return assignments.join(F.broadcast(sizes), "group_id")  # at most MAX_GROUPS rows


def _unpivot(df: DataFrame, keep: list[str], features: list[str]) -> DataFrame:
    typed = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return typed.unpivot(keep, features, "feature", "value")


def peer_stats(recent: DataFrame, assignments: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity", p95: bool = True) -> DataFrame:
    """(group_id, feature, mean, std, p95) over the members' recent rows, groups of 3 or more only.

    ``recent`` is the output of ``profile.recent_rows``. The recent rows of a group grow with its
    members, so everything combines map-side; p95, which no score uses, can be left out. It reads the members' rows
    three times, so they are stored once.
    """
    sized = with_group_size(assignments, key).filter(F.col("group_size") >= C.MIN_GROUP_SIZE)
    rows = recent.join(sized, key).select("group_id", "group_size", *features)
    long = _unpivot(materialize(rows, "members") if p95 else rows, ["group_id", "group_size"], features)
    long = long.withColumn("value", F.expr("if(isnan(value) or abs(value) = double('inf'), null, value)"))
    keys = ["group_id", "feature"]
    stats = long.groupBy(*keys, "group_size").agg(
        F.coalesce(F.avg("value"), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_pop("value"), F.lit(1.0)).alias("std"))
    if not p95:
        return stats
    ranks = exact_percentile(long, keys, "value", 0.95, "p95", few_groups=True)  # MAX_GROUPS x features
    return stats.join(ranks, keys, "left").withColumn("p95", F.coalesce("p95", F.lit(0.0)))


def stats_wide(stats: DataFrame, features: list[str] = C.TRAFFIC_FEATURES) -> DataFrame:
    """One row per group with g_mean_*/g_std_* columns; at most MAX_GROUPS rows."""
    pick = lambda f, col, out: F.expr(f"max(case when feature = '{f}' then {col} end) as {out}_{f}")
    return stats.groupBy("group_id").agg(
        F.max("group_size").alias("group_size"),
        *[pick(f, "mean", "g_mean") for f in features], *[pick(f, "std", "g_std") for f in features],
    )


def group_moments(recent: DataFrame, assignments: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity") -> DataFrame:
    """The columns of ``stats_wide`` straight from the recent rows, without the long format: all
    that the peer score needs, in one aggregation."""
    sized = with_group_size(assignments, key).filter(F.col("group_size") >= C.MIN_GROUP_SIZE)
    rows = recent.join(sized, key)
    x = lambda f: f"if(isnan({f}) or abs({f}) = double('inf'), null, cast({f} as double))"
    return rows.groupBy("group_id").agg(
        F.max("group_size").alias("group_size"),
        *[F.expr(f"coalesce(avg({x(f)}), 0.0D) as g_mean_{f}") for f in features],
        *[F.expr(f"coalesce(stddev_pop({x(f)}), 1.0D) as g_std_{f}") for f in features],
    )


def peer_score(features: list[str] = C.TRAFFIC_FEATURES) -> Column:
    """Mean of the capped z-score against the group over the features that are finite; 0.0 without group
    statistics or without such a feature.

    Needs the columns of ``stats_wide`` joined to the row.
    """
    fine = lambda f: f"({f} is not null and not isnan({f}) and abs({f}) < double('inf') and g_mean_{f} is not null)"
    part = lambda f: (
        f"if({fine(f)}, if(g_std_{f} < 1e-6D, if(abs({f} - g_mean_{f}) > 1e-6D, 1.0D, 0.0D), least(abs({f} - g_mean_{f}) / g_std_{f} / 3.0D, 1.0D)), 0.0D)")
    used = " + ".join(f"cast({fine(f)} as int)" for f in features)
    return F.expr(f"coalesce(({' + '.join(map(part, features))}) / nullif({used}, 0), 0.0D)")


def group_sizes(assignments: DataFrame, k: int | None = None) -> DataFrame:
    """Members per group and the average size over all ``k`` groups, empty ones included (default: those with members)."""
    sizes = assignments.groupBy("group_id").agg(F.count("*").alias("members"))
    every = Window.partitionBy(F.lit(1))  # <= MAX_GROUPS rows
    return sizes.withColumn("avg_members", F.sum("members").over(every) / (F.count("*").over(every) if k is None else F.lit(k)))


def versioned(df: DataFrame, ts: str = "ts", tie: str = "event_id", every: int = C.PEER_REFRESH_ROWS) -> DataFrame:
    """Adds the number of group refreshes seen when the row is scored: the refresh happens at every
    ``every``-th message of the whole stream and is visible from that message on."""
    return sequenced(df, [], ts, tie, "global_seq").withColumn("version", F.expr(f"global_seq div {every}"))


def refresh_peer_stats(df: DataFrame, features: list[str], group: str = "group_id", ts: str = "ts", tie: str = "event_id", every: int = C.PEER_REFRESH_ROWS) -> DataFrame:
    """As-of group means: each row with the mean of ``features`` over its group's rows up to the
    latest refresh at or before the row (null before the first refresh that saw the group).

    Rows are pre-aggregated to (group, refresh interval); running sums over these small rows give
    every version, and the row picks its version by equality.
    """
    e = versioned(df, ts, tie, every).withColumn("_slot", F.expr(f"(global_seq - 1) div {every}"))
    sums = e.groupBy(group, "_slot").agg(F.count("*").alias("_n"), *[F.sum(f).alias(f"_s_{f}") for f in features])
    # A row is last of its slot when it triggers the refresh itself and then sees the slot's rows.
    totals = ["_n", *[f"_s_{f}" for f in features]]
    run = running_totals(sums, [group], "_slot", totals, block=10_000)
    run = run.select(
        group, "_slot",
        *[F.nullif(F.col(f"{c}_before"), F.lit(0)).alias(f"{c}_before") if c == "_n" else F.col(f"{c}_before") for c in totals],
        *[(F.coalesce(f"{c}_before", F.lit(0)) + F.col(c)).alias(f"{c}_upto") for c in totals],
    )
    trigger = F.col("version") > F.col("_slot")
    run = run.withColumnsRenamed({group: "_group", "_slot": "_run_slot"})  # a null group is a group, too
    out = e.join(run, e[group].eqNullSafe(run["_group"]) & (e["_slot"] == run["_run_slot"]))
    pick = lambda c: F.when(trigger, F.col(f"{c}_upto")).otherwise(F.col(f"{c}_before"))
    n = pick("_n")
    return out.select(
        *df.columns, "global_seq", "version", n.alias("group_rows"),
        *[(pick(f"_s_{f}") / n).alias(f"group_avg_{f}") for f in features],
    )


