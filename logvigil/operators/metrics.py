"""Counters and evaluation, each one aggregation with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from .detect import anomaly_trigger


def dfp_metrics(scored: DataFrame, every: int = C.PEER_REFRESH_ROWS) -> DataFrame:
    """Totals of a scored table. Counts per entity first, so distinct entities need no set.

    ``peer_anomalies_detected`` counts every anomaly, as ``anomalies_detected`` does. Entities that were skipped
    keep no profile and are not among the totals of entities.
    """
    per = scored.groupBy("dfp_entity").agg(
        F.count("*").alias("n"), F.sum("dfp_is_anomaly").alias("a"),
        F.max(F.when(F.col("dfp_status") == "trained", 1).otherwise(0)).alias("t"),
        F.max(F.when(F.col("dfp_status").isin("trained", "training"), 1).otherwise(0)).alias("f"), F.max("dfp_peer_group_id").alias("g"))
    return per.agg(
        F.count_if(F.col("dfp_entity").isNotNull() & (F.col("f") == 1)).alias("total_entities"), F.sum("t").alias("trained_models"),
        F.sum("a").alias("anomalies_detected"), F.sum("f").alias("profiles_created"), F.sum("n").alias("messages_processed"),
        F.countDistinct("g").alias("peer_groups"), F.sum("a").alias("peer_anomalies_detected"),
        F.expr(f"sum(n) div {every}").alias("peer_grouping_runs"),
    )


def detection_metrics(results: DataFrame) -> DataFrame:
    """total, regex hits, classified, threats and the anomaly sources of a ``threat_result`` table."""
    regex, trigger = F.col("stages_used") == "regex", anomaly_trigger()
    return results.agg(
        F.count("*").alias("total"), F.count_if(regex).alias("regex_hits"), F.count_if(~regex).alias("classified"),
        F.count_if(F.col("is_threat") == 1).alias("threats"),
        F.round(F.count_if(F.col("is_threat") == 1) / F.nullif(F.count("*"), F.lit(0)) * 100, 4).alias("threat_pct"),
        *[F.count_if(~regex & (trigger == s)).alias(f"dfp_{s}") for s in ("individual", "peer", "both")],
    )


def review_metrics(reviewed: DataFrame) -> DataFrame:
    status = lambda s: F.count_if(F.col("llm_status") == s)
    return reviewed.agg(
        F.count("*").alias("consumed"), status("analyzed").alias("analyzed"), status("skipped_cooldown").alias("skipped_cooldown"),
        status("skipped_threshold").alias("skipped_threshold"),
        F.count_if((F.col("llm_status") == "analyzed") & (F.col("llm_is_suspicious") == 1)).alias("threats"),
        F.round(status("analyzed") / F.nullif(F.count("*"), F.lit(0)) * 100, 4).alias("analysis_rate"),
    )


def top_entities(scored: DataFrame, n: int = 3) -> DataFrame:
    """The busiest entities with profile and group state."""
    profiled = F.max(F.when(F.col("dfp_status").isin("trained", "training"), 1).otherwise(0)) == 1
    per = scored.filter(F.col("dfp_entity").isNotNull()).groupBy("dfp_entity").agg(
        F.count("*").alias("messages"), F.when(profiled, "profiled").otherwise("tracking").alias("status"),
        F.coalesce(F.max("dfp_peer_group_id").cast("string"), F.lit("ungrouped")).alias("peer_group"))
    return per.orderBy(F.desc("messages"), "dfp_entity").limit(n)


def throughput(df: DataFrame, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Messages per window; also runs on a stream."""
    # a cast would hide a stream's watermark, so it is applied only where needed
    at = F.col(ts) if dict(df.dtypes)[ts] == "timestamp" else F.col(ts).cast("timestamp")
    return df.groupBy(F.window(at, width)).agg(F.count("*").alias("messages")).select(
        F.col("window.start").alias("window_start"), "messages")


def class_distribution(df: DataFrame, label: str = "threat_class") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def evaluate_classifier(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and weighted F1 from the confusion counts (one small row per label pair)."""
    cells = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    both = cells.select(F.explode(F.array(
        F.struct(F.col(label).alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("called"),
                 F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col(prediction).alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")),
    )).alias("x")).select("x.*")
    per = both.groupBy("c").agg(*[F.sum(k).alias(k) for k in ("actual", "called", "tp")])
    f1 = F.when(F.col("actual") + F.col("called") > 0, 2 * F.col("tp") / (F.col("actual") + F.col("called"))).otherwise(0.0)
    return per.agg(
        F.sum("actual").alias("total"), (F.sum("tp") / F.sum("actual")).alias("accuracy"),
        (F.sum(F.col("actual") * f1) / F.sum("actual")).alias("f1"))


def prepare_training_set(df: DataFrame, label: str = "label", key: str = "id", cap: int = 100_000, normal="normal") -> DataFrame:
    """Cap each class but ``normal`` at ``cap`` rows by hash order and split about 80/20.

    The cap is the class balancing itself. Adds ``split`` (train or validation).
    """
    e = df.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_p", F.substring("_h", 1, 4))
    is_free = F.coalesce(F.col(label) == F.lit(normal), F.lit(False))
    # Rows of a class are counted by hash prefix. Prefixes below the cap stay whole, those above it
    # go, and only the one prefix that straddles it (1/65,536 of a class) is ranked.
    counts = e.filter(~is_free).groupBy(label, "_p").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter(F.col("_before") < cap)
    match = (F.col("e._p") == F.col("c._p")) & F.col(f"e.{label}").eqNullSafe(F.col(f"c.{label}"))
    near = e.filter(~is_free).alias("e").join(counts.alias("c"), match).select("e.*", "c._n", "c._before")
    whole = F.col("_before") + F.col("_n") <= cap
    rank = F.row_number().over(Window.partitionBy(label, "_p").orderBy("_h", key))
    part = near.filter(~whole).withColumn("_r", rank).filter(F.col("_r") + F.col("_before") <= cap)
    kept = e.filter(is_free).select(*df.columns, "_h")
    for rows in (near.filter(whole), part):
        kept = kept.unionByName(rows.select(*df.columns, "_h"))
    split = F.when(F.substring("_h", 1, 2) < "33", "validation").otherwise("train")
    return kept.withColumn("split", split).drop("_h")


def message_size(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Average serialized size of the rows."""
    return F.avg(F.octet_length(F.to_json(F.struct(*(columns or df.columns)))))


def documents_per_day(df: DataFrame, ts: str = "ts", keep_days: int | None = None, today: Column | None = None) -> DataFrame:
    """Documents per day, optionally only those younger than ``keep_days``."""
    out = df
    if keep_days is not None:
        now = F.current_date() if today is None else today
        out = out.filter(F.col(ts) >= F.date_sub(now, keep_days).cast("timestamp"))
    return out.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("documents"))
