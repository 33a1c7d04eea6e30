"""Per-entity behaviour: rolling windows, training baseline, error threshold and status.

All windows of one plan share ``partitionBy(entity).orderBy(seq)``, so Spark does one exchange and
one sort. Entities above the hot-row limit are processed in chunks, see ``functions.skew``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C

from ..functions.skew import numbered, rolling
from .features import sanitize, sanitize_sql


def entity_sequence(df: DataFrame, key: str = "entity", ts: str = "ts", tie: str = "event_id", hot_rows: int | None = None) -> DataFrame:
    """Running message number per entity."""
    return numbered(df, key, ts, tie, "seq", hot_rows)


def _frame(part: list[str], rows: int, seq: str = "seq"):
    return Window.partitionBy(*part).orderBy(seq).rowsBetween(-(rows - 1), 0)


def entropy_of(values: Column) -> Column:
    """Shannon entropy (base 2) of the values of an array, 0.0 for fewer than two."""
    n = F.size(values)

    def add(acc: Column, v: Column) -> Column:
        p = (n - F.size(F.array_remove(values, v))) / n
        return acc - p * F.log2(p)

    return F.when(n > 1, F.abs(F.aggregate(F.array_distinct(values), F.lit(0.0), add))).otherwise(F.lit(0.0))


def add_port_entropy(df: DataFrame, part: list[str], rows: int = C.RING_ROWS) -> DataFrame:
    ring = F.collect_list(F.coalesce(F.col("dstport").cast("double"), F.lit(0.0))).over(_frame(part, rows))
    return df.withColumn("_ports", ring).withColumn("port_entropy", entropy_of(F.col("_ports"))).drop("_ports")


def add_byte_variance(df: DataFrame, part: list[str], rows: int = C.RING_ROWS) -> DataFrame:
    return df.withColumn("byte_variance", F.coalesce(F.var_pop("total_bytes").over(_frame(part, rows)), F.lit(0.0)))


def port_entropy(df: DataFrame, key: str = "entity", ts: str = "ts", tie: str = "event_id", rows: int = C.RING_ROWS, hot_rows: int | None = None) -> DataFrame:
    """Entropy of dstport over the entity's last ``rows`` events, this one included."""
    return rolling(df, key, ts, tie, rows - 1, lambda d, p: add_port_entropy(d, p, rows), hot_rows)


def byte_variance(df: DataFrame, key: str = "entity", ts: str = "ts", tie: str = "event_id", rows: int = C.RING_ROWS, hot_rows: int | None = None) -> DataFrame:
    """Population variance of total_bytes over the entity's last ``rows`` events."""
    return rolling(df, key, ts, tie, rows - 1, lambda d, p: add_byte_variance(d, p, rows), hot_rows)


def rolling_history(df: DataFrame, columns: list[str], key: str = "entity", ts: str = "ts", tie: str = "event_id", rows: int = C.HISTORY_ROWS, keep: bool = False, hot_rows: int | None = None) -> DataFrame:
    """The entity's last ``rows`` feature rows: their number and the mean of each column;
    ``keep=True`` also keeps them as an array of structs (at most ``rows`` entries)."""

    def build(d: DataFrame, part: list[str]) -> DataFrame:
        w = _frame(part, rows)
        cols = {"history_rows": F.count("*").over(w)}
        cols.update({f"history_avg_{c}": F.avg(c).over(w) for c in columns})
        if keep:
            cols["history"] = F.collect_list(F.struct(*columns)).over(w)
        return d.withColumns(cols)

    return rolling(df, key, ts, tie, rows - 1, build, hot_rows)


def admit_entities(df: DataFrame, max_entities: int, key: str = "entity", min_rows: int = C.MIN_ENTITY_ROWS) -> DataFrame:
    """The entities that keep a profile: the ``max_entities`` most active ones.

    While there is room every entity is admitted; beyond it an entity needs ``min_rows`` messages.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("messages"))
    # one more than the cap tells whether there is room; the ranking is over that many rows only
    top = counts.orderBy(F.desc("messages"), key).limit(max_entities + 1)
    all_top = Window.partitionBy(F.lit(1))
    ranked = top.withColumns({
        "_room": F.count("*").over(all_top) <= max_entities,
        "_rank": F.row_number().over(all_top.orderBy(F.desc("messages"), key)),
    })
    return ranked.filter((F.col("_rank") <= max_entities) & (F.col("_room") | (F.col("messages") >= min_rows))).select(key, "messages")


def keep_admitted(df: DataFrame, admitted: DataFrame, key: str = "entity") -> DataFrame:
    """Only rows of admitted entities. Spark's own size check decides how they are joined."""
    return df.join(admitted.select(key), key, "left_semi")


def training_ready(df: DataFrame, key: str = "entity", ts: str = "ts", tie: str = "event_id", rows: int = C.TRAINING_ROWS) -> DataFrame:
    """The row at which each entity's history first holds ``rows`` events.

    The row-number filter becomes a group limit ahead of the shuffle, so a hot entity costs no
    more than any other.
    """
    return head_rows(df, rows, key, ts, tie).filter(F.col("seq") == rows)


def head_rows(df: DataFrame, rows: int, key: str = "entity", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    order = Window.partitionBy(key).orderBy(ts, tie)
    return df.withColumn("seq", F.row_number().over(order)).filter(F.col("seq") <= rows)


def tail_rows(df: DataFrame, rows: int, key: str = "entity", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Each entity's last ``rows`` rows; ``back`` is 1 for the newest."""
    order = Window.partitionBy(key).orderBy(F.desc(ts), F.desc(tie))
    return df.withColumn("back", F.row_number().over(order)).filter(F.col("back") <= rows)


def add_rings(df: DataFrame, part: list[str]) -> DataFrame:
    return add_byte_variance(add_port_entropy(df, part), part)


def recent_rows(df: DataFrame, rows: int = C.RECENT_ROWS, key: str = "entity", ts: str = "ts", tie: str = "event_id", features: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Each entity's last ``rows`` events with entropy and variance filled in; ``features`` adds the
    per-event features to the few rows that are left, where ``df`` does not have them yet.

    The rings look back another RING_ROWS - 1 rows, so that many more are fetched; nothing else of
    the entity is shuffled.
    """
    tail = tail_rows(df, rows + C.RING_ROWS - 1, key, ts, tie).withColumn("seq", -F.col("back"))
    tail = features(tail) if features else tail
    return add_rings(tail, [key]).filter(F.col("back") <= rows).drop("seq")


def _std_floor(c: Column) -> Column:
    return F.when(c < 1e-6, 1.0).otherwise(c)


def entity_baseline(df: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity", ts: str = "ts", tie: str = "event_id", rows: int = C.TRAINING_ROWS) -> DataFrame:
    """Mean and population deviation of each feature over the entity's training rows.

    Needs the per-event features. Deviations below 1e-6 become 1.0; entities that have not yet
    reached ``rows`` events have no baseline.
    """
    heads = add_rings(head_rows(df, rows, key, ts, tie), [key])
    aggs = []
    for f in features:
        x = sanitize(heads, f)
        aggs += [F.avg(x).alias(f"mean_{f}"), _std_floor(F.stddev_pop(x)).alias(f"std_{f}")]
    return heads.groupBy(key).agg(F.count("*").alias("training_rows"), *aggs).filter(F.col("training_rows") == rows)


def add_running_baseline(df: DataFrame, part: list[str], features: list[str], rows: int = C.TRAINING_ROWS) -> DataFrame:
    """The same baseline as running aggregates over rows numbered 1..``rows``: complete from row
    ``rows`` on, in the exchange and sort the other windows already use."""
    over = f"over (partition by {', '.join(part)} order by seq rows between unbounded preceding and current row)"
    cols = {}
    for f in features:
        x = f"case when seq <= {rows} then {sanitize_sql(f)} end"
        cols[f"mean_{f}"] = F.expr(f"avg({x}) {over}")
        cols[f"std_{f}"] = F.expr(f"stddev_pop({x}) {over}")
    floor = {f"std_{f}": F.expr(f"if(std_{f} < 1e-6D, 1.0D, std_{f})") for f in features}
    return df.withColumns(cols).withColumns(floor)


def scaled_error(features: list[str] = C.TRAFFIC_FEATURES) -> Column:
    """Mean squared error of the scaled vector against the baseline mean (the ``zero`` scorer)."""
    z = [f"power(({sanitize_sql(f)} - mean_{f}) / std_{f}, 2)" for f in features]
    return F.expr(f"({' + '.join(z)}) / {len(features)}")


def reconstruction_error(df: DataFrame, baseline: DataFrame, features: list[str] = C.TRAFFIC_FEATURES, key: str = "entity") -> DataFrame:
    """Adds ``recon_err`` for rows of entities with a baseline; AQE splits a hot entity's join."""
    joined = df.join(baseline, key, "left")
    names = [f"{p}_{f}" for f in features for p in ("mean", "std")]
    return joined.withColumn("recon_err", scaled_error(features)).drop("training_rows", *names)


def add_error_window(df: DataFrame, part: list[str], rows: int = C.ERROR_ROWS, pct: float = C.ERROR_PERCENTILE) -> DataFrame:
    """err_count, err_min, err_max and the percentile threshold of the last ``rows`` errors.

    One bounded array per row serves all four. The percentile interpolates linearly between the
    two order statistics around ``pct * (n - 1)``.
    """
    # an invalid error is no part of any window
    fine = F.when(~F.isnan("recon_err") & (F.abs("recon_err") < float("inf")), F.col("recon_err"))
    errs = df.withColumn("_errs", F.sort_array(F.collect_list(fine).over(_frame(part, rows))))
    e, n = F.col("_errs"), F.size("_errs")
    pos = F.lit(pct) * (n - 1)
    at = F.floor(pos).cast("int")
    low = F.get(e, at)
    high = F.coalesce(F.get(e, at + 1), low)
    return errs.withColumns({
        "err_count": n,
        "err_min": F.get(e, F.lit(0)),
        "err_max": F.get(e, n - 1),
        "threshold": F.when(n > 0, low + (pos - at) * (high - low)),
    }).drop("_errs")


def individual_score() -> Column:
    """Position of the error inside the window's range, in [0, 1]; needs ``add_error_window``."""
    err, lo, hi = F.col("recon_err"), F.col("err_min"), F.col("err_max")
    span = hi - lo
    flat = F.when(err > F.col("threshold"), 0.5).otherwise(0.0)
    raw = F.least(F.greatest((err - lo) / span, F.lit(0.0)), F.lit(1.0))
    return F.when(span < 1e-8, flat).when(raw < 1e-10, 0.0).otherwise(raw)


def combine_scores(individual: Column, peer: Column, individual_anomaly: Column) -> tuple[Column, Column]:
    """(score, is_anomaly flag) from the entity's own score and the peer score."""
    both = C.INDIVIDUAL_WEIGHT * individual + C.PEER_WEIGHT * peer
    has_peer = peer > 0
    score = F.when(has_peer, both).otherwise(individual)
    anomaly = F.when(
        has_peer,
        (both > 0.7) | ((individual > 0.8) & (peer > 0.5)) | ((individual > 0.5) & (peer > 0.8)),
    ).otherwise(individual_anomaly)
    return score, F.when(anomaly, 1).otherwise(0)


def dfp_status(entity: Column, seq: Column, admitted: Column | None = None, enabled: bool = True) -> Column:
    if not enabled:
        return F.lit("disabled")
    out = F.when(entity.isNull(), "no_entity")
    if admitted is not None:
        out = out.when(~admitted, "skipped")
    return out.when(seq >= C.TRAINING_ROWS, "trained").otherwise("training")


def dfp_method(status: Column, err: Column, err_count: Column, peer: Column) -> Column:
    return (
        F.when(status != "trained", "none")
        .when(err.isNull(), "no_model")
        .when(F.isnan(err) | (F.abs(err) == float("inf")), "invalid_error")
        .when(err_count < C.MIN_ERRORS, "insufficient_history")
        .when(peer > 0, "individual_and_peer")
        .otherwise("individual_only")
    )


