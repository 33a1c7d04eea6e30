"""The behaviour-scoring plan: features, rolling rings, baseline, threshold, peers and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.fields import event_time
from ..operators import features as FE
from ..operators import models as MO
from ..operators import peer_versions as PV
from ..operators import peers as PE
from ..operators import profile as PR
from ..session import materialize

DFP_COLUMNS = [
    "dfp_is_anomaly", "dfp_score", "dfp_individual_score", "dfp_peer_score", "dfp_entity",
    "dfp_status", "dfp_peer_group_id", "dfp_peer_group_size", "dfp_detection_method",
]

_EVENT_FEATURES = [f for f in C.TRAFFIC_FEATURES if f not in ("port_entropy", "byte_variance")]


# Raw fields the features read.
_RAW_FIELDS = [
    "srcip", "dstip", "srcport", "dstport", "proto", "action", "type", "subtype", "appid",
    "sentbyte", "rcvdbyte", "sentpkt", "rcvdpkt", "duration", "sentdelta", "rcvddelta",
]


def narrow(e: DataFrame, ts: str = "ts", tie: str = "event_id", clock: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """(tie, ts, entity, _at, raw fields): what goes through the shuffle. The 34 features are twice
    as wide, so they are computed behind it. Columns named in ``keep`` travel along in ``_event``."""
    at = event_time(e) if clock is None else clock
    raw = [F.col(c) for c in _RAW_FIELDS if c in e.columns]
    if keep:
        raw.append(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_event"))
    return e.select(F.col(tie), F.col(ts), FE.entity_key(e).alias("entity"), at.alias("_at"), *raw)


def add_features(d: DataFrame, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Event features in place of the raw fields of a ``narrow`` frame."""
    f = FE.event_features(d, clock=F.col("_at"))
    own = [c for c in d.columns if c not in (*_RAW_FIELDS, "_at", tie, ts, "entity")]
    return f.select(F.col(tie), F.col(ts), "entity", *own, *_EVENT_FEATURES)


def prepare(e: DataFrame, ts: str = "ts", tie: str = "event_id", clock: Column | None = None) -> DataFrame:
    """(tie, ts, entity, event features)."""
    return add_features(narrow(e, ts, tie, clock), ts, tie)


def _halo() -> int:
    return C.ERROR_ROWS - 1 + C.RING_ROWS - 1


def decide(d: DataFrame, ts: str, tie: str, assignments: DataFrame | None = None, wide: DataFrame | None = None) -> DataFrame:
    """Scores and status from sequence number, error and error window (batch and stream).

    ``wide`` has one row per group, so it is broadcast. ``assignments`` grows with the entities and
    is joined as Spark finds it fit; AQE splits a hot entity's side. With a column ``version`` both
    are tables by version, and a row takes the ones of its own.
    """
    if wide is not None and "version" in wide.columns:
        d = d.join(assignments, ["entity", "version"], "left").join(wide, ["group_id", "version"], "left")
        peer, gid, gsize = PE.peer_score(C.TRAFFIC_FEATURES), F.col("group_id"), F.col("group_size")
    elif wide is not None:
        d = d.join(assignments, "entity", "left")
        d = d.join(F.broadcast(wide), "group_id", "left")  # at most MAX_GROUPS rows
        peer, gid, gsize = PE.peer_score(C.TRAFFIC_FEATURES), F.col("group_id"), F.col("group_size")
    else:
        peer, gid, gsize = F.lit(0.0), F.lit(None).cast("int"), F.lit(None).cast("int")
    fine = F.col("recon_err").isNotNull() & ~F.isnan("recon_err") & (F.abs("recon_err") < float("inf"))
    scored = (F.col("seq") >= C.TRAINING_ROWS) & (F.col("err_count") >= C.MIN_ERRORS) & fine
    grouped = scored & gsize.isNotNull()
    d = d.withColumns({
        "_ind": F.when(scored, PR.individual_score()).otherwise(0.0),
        "_peer": F.when(grouped, peer).otherwise(0.0),
        "_gid": F.when(grouped, gid),
        "_gsize": F.when(grouped, gsize).otherwise(0),
        "_over": scored & (F.col("recon_err") > F.col("threshold")),
    })
    combined, anomaly = PR.combine_scores(F.col("_ind"), F.col("_peer"), F.col("_over"))
    status = PR.dfp_status(F.col("entity"), F.col("seq"))
    keep = [c for c in ("_home", "_chunk", "_event") if c in d.columns]
    return d.select(
        F.col(tie), F.col(ts), *keep, "seq", "recon_err", "threshold",
        anomaly.alias("dfp_is_anomaly"), combined.alias("dfp_score"),
        F.col("_ind").alias("dfp_individual_score"), F.col("_peer").alias("dfp_peer_score"),
        F.col("entity").alias("dfp_entity"), status.alias("dfp_status"),
        F.col("_gid").cast("int").alias("dfp_peer_group_id"), F.col("_gsize").cast("int").alias("dfp_peer_group_size"),
        PR.dfp_method(status, F.col("recon_err"), F.col("err_count"), F.col("_peer")).alias("dfp_detection_method"),
    )


def score(
    e: DataFrame,
    ts: str = "ts",
    tie: str = "event_id",
    clock: Column | None = None,
    assignments: DataFrame | None = None,
    stats: DataFrame | None = None,
    hot_rows: int | None = None,
    scorer: str = "zero",
    keep: list[str] | None = None,
    every: int = C.PEER_REFRESH_ROWS,
) -> DataFrame:
    """Score every event: (tie, ts, 9 dfp_ columns), one output row per input row.

    ``keep`` names event columns to carry through the same shuffle into the result, so that nothing has to be
    joined back by an id.

    ``assignments`` (entity, group_id) adds the peer layer with one set of group statistics for all
    rows; ``stats`` is the table of ``peers.peer_stats`` and is computed from ``e`` when not given.
    With a column ``version`` the groups are refreshed at every ``every``-th message: an event is scored
    against the groups and statistics of the latest refresh, see ``operators.peer_versions``; events before
    the first one have no peers. ``scorer`` is how an event is
    reconstructed: ``zero`` (by the baseline mean, all in the JVM), ``pca`` or ``autoencoder`` (a
    model per entity, see ``operators.models``).
    """
    feats = C.TRAFFIC_FEATURES
    base = narrow(e, ts, tie, clock, keep)
    versions = assignments is not None and "version" in assignments.columns
    if versions:
        base = materialize(PE.versioned(base, ts, tie, every), "versioned")  # read by the score and by the refreshes
    known = base.filter(F.col("entity").isNotNull())
    featured = lambda d: add_features(d, ts, tie)
    wide = groups = None
    if versions:
        seen = featured(known.drop("_event"))
        groups, wide = PV.versions_for(seen, assignments, every, feats, ts=ts, tie=tie, hot_rows=hot_rows)
    elif assignments is not None:
        groups = assignments.select("entity", "group_id").filter(F.col("entity").isNotNull())
        if stats is None:
            wide = PE.group_moments(PR.recent_rows(known.drop("_event"), ts=ts, tie=tie, features=featured), groups, feats)
        else:
            wide = PE.stats_wide(stats, feats)

    def finish(d: DataFrame, part: list[str]) -> DataFrame:
        return decide(PR.add_error_window(d, part), ts, tie, groups, wide)

    def zero_error(d: DataFrame) -> DataFrame:
        d = d.withColumn("recon_err", F.when(F.col("seq") >= C.TRAINING_ROWS, PR.scaled_error(feats)))
        return d.drop(*[f"{p}_{f}" for f in feats for p in ("mean", "std")])

    def build(d: DataFrame, part: list[str]) -> DataFrame:
        return finish(zero_error(PR.add_running_baseline(PR.add_rings(featured(d), part), part, feats)), part)

    def build_hot(d: DataFrame, part: list[str]) -> DataFrame:
        # A chunk cannot see the entity's first rows, so the baseline is joined. Only hot entities
        # get here; their number is bounded by (all rows / hot_rows).
        d = featured(d)
        first = d.filter((F.col("_home") == F.col("_chunk")) & (F.col("seq") <= C.TRAINING_ROWS))
        baseline = PR.entity_baseline(first, feats, "entity", ts, tie)
        joined = PR.add_rings(d, part).join(F.broadcast(baseline.drop("training_rows")), "entity", "left")
        return finish(zero_error(joined), part)

    if scorer == "zero":
        out = PR.rolling(known, "entity", ts, tie, _halo(), build, hot_rows, build_hot)
    else:
        rows = PR.rolling(known, "entity", ts, tie, C.RING_ROWS - 1, lambda d, p: PR.add_rings(featured(d), p), hot_rows)
        params = MO.train_models(featured(PR.head_rows(known.drop("_event"), C.TRAINING_ROWS, "entity", ts, tie)), scorer, "entity", ts, tie)
        # the models are trained once per run, not once per use of the errors
        rows = materialize(MO.model_errors(rows, params, scorer, ts=ts, tie=tie), "errors")
        out = PR.rolling(rows, "entity", ts, tie, C.ERROR_ROWS - 1, finish, hot_rows, has_seq=True)
    out = out.unionByName(empty_result(base.filter(F.col("entity").isNull()), ts, tie, "no_entity"))
    if not keep:
        return out
    own = [c for c in out.columns if c != "_event"]
    return out.select(*own, *[F.col(f"_event.`{c}`").alias(c) for c in keep if c not in own])


def empty_result(df: DataFrame, ts: str, tie: str, status: str) -> DataFrame:
    """The dfp columns of rows that are not scored."""
    null = F.lit(None)
    return df.select(
        F.col(tie), F.col(ts), null.cast("bigint").alias("seq"), null.cast("double").alias("recon_err"),
        null.cast("double").alias("threshold"), F.lit(0).alias("dfp_is_anomaly"), F.lit(0.0).alias("dfp_score"),
        F.lit(0.0).alias("dfp_individual_score"), F.lit(0.0).alias("dfp_peer_score"),
        F.col("entity").alias("dfp_entity"), F.lit(status).alias("dfp_status"),
        null.cast("int").alias("dfp_peer_group_id"), F.lit(0).alias("dfp_peer_group_size"),
        F.lit("none").alias("dfp_detection_method"), *[c for c in df.columns if c == "_event"],
    )


def score_admitted(e: DataFrame, max_entities: int, ts: str = "ts", tie: str = "event_id", clock: Column | None = None, **kw) -> DataFrame:
    """``score`` for the most active entities only; rows of the others get status ``skipped``."""
    keyed = e.withColumn("entity", FE.entity_key(e))
    top = materialize(PR.admit_entities(keyed, max_entities).select("entity"), "admitted")
    kept = keyed.join(top, "entity", "left_semi")
    rest = keyed.join(top, "entity", "left_anti")
    out = score(kept.drop("entity"), ts, tie, clock, **kw)
    rest = rest.drop("_event")
    skipped = empty_result(rest.filter(F.col("entity").isNotNull()), ts, tie, "skipped")
    nobody = empty_result(rest.filter(F.col("entity").isNull()), ts, tie, "no_entity")
    return out.unionByName(skipped).unionByName(nobody)
