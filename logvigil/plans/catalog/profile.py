"""Behaviour-profile queries, up to the flagship score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import features as FE
from ...operators import peer_versions as PV
from ...operators import peers as PE
from ...operators import profile as PR
from ...session import materialize
from .. import dfp
from .features import feature_sql
from .registry import query, view, with_view

GROUPS = 5
# Some of the 34 features, for queries that print per-feature values.
SHOWN = ["sentbyte", "dstport", "hour", "total_bytes", "bytes_ratio", "port_entropy", "byte_variance"]


def portable_groups(e):
    """A fixed assignment both engines can compute: last octet modulo GROUPS."""
    return e.select("entity").distinct().withColumn(
        "group_id", (F.split_part("entity", F.lit("."), F.lit(4)).cast("int") % GROUPS))


_GROUP_SQL = f"cast(split_part(entity, '.', 4) as int) % {GROUPS}"


def _events(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    return dfp.prepare(e, clock=F.col("ts"))


def rings_sql() -> str:
    """Features with sequence number, entropy and variance."""
    return f"""select *, coalesce(var_pop(total_bytes) over r20, 0.0) as byte_variance,
 case when count(*) over r20 > 1 then entropy(dstport) over r20 else 0.0 end as port_entropy,
 row_number() over (partition by entity order by ts, event_id) as seq,
 row_number() over (partition by entity order by ts desc, event_id desc) as back
 from ({feature_sql()}) f1
 window r20 as (partition by entity order by ts, event_id rows between 19 preceding and current row)"""


def _seq(body: str) -> str:
    return with_view("fw", f"select * from (with rings as ({rings_sql()}) {body}) q")


@query("entity_sequence", _seq("select event_id, entity, seq from rings"))
def entity_sequence(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    return PR.entity_sequence(e.select("event_id", "ts", FE.entity_key(e).alias("entity"))).select("event_id", "entity", "seq")


@query("rolling_history", _seq("""select event_id, count(*) over w as history_rows, round(avg(sentbyte) over w, 6) as history_avg_sentbyte
 from rings window w as (partition by entity order by seq rows between 39 preceding and current row)"""))
def rolling_history(spark, sf_dir):
    h = PR.rolling_history(_events(spark, sf_dir).select("event_id", "ts", "entity", "sentbyte"), ["sentbyte"])
    return h.select("event_id", "history_rows", F.round("history_avg_sentbyte", 6).alias("history_avg_sentbyte"))


@query("port_entropy", _seq("select event_id, round(port_entropy, 6) as port_entropy from rings"))
def port_entropy(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "ts", "entity", "dstport")
    return PR.port_entropy(e).select("event_id", F.round("port_entropy", 6).alias("port_entropy"))


@query("byte_variance", _seq("select event_id, round(byte_variance, 4) as byte_variance from rings"))
def byte_variance(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "ts", "entity", "total_bytes")
    return PR.byte_variance(e).select("event_id", F.round("byte_variance", 4).alias("byte_variance"))


@query("admit_entities", with_view("fw", f"""select srcip as entity, count(*) as messages from fw group by 1
 qualify row_number() over (order by count(*) desc, srcip) <= {C.MAX_ENTITIES}
 and (count(*) over () <= {C.MAX_ENTITIES} or count(*) >= {C.MIN_ENTITY_ROWS})"""))
def admit_entities(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    return PR.admit_entities(e.select(FE.entity_key(e).alias("entity")), C.MAX_ENTITIES)


@query("training_ready", _seq("select event_id, entity from rings where seq = 15"))
def training_ready(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    return PR.training_ready(e.select("event_id", "ts", FE.entity_key(e).alias("entity"))).select("event_id", "entity")


def baseline_sql(names=C.TRAFFIC_FEATURES) -> str:
    cols = ", ".join(
        f"avg({f}) as mean_{f}, case when stddev_pop({f}) < 1e-6 then 1.0 else stddev_pop({f}) end as std_{f}" for f in names)
    return f"select entity, {cols} from rings where seq <= 15 group by entity having count(*) = 15"


@query("entity_baseline", _seq(f"""select entity, {", ".join(f"round(mean_{f}, 4) as mean_{f}, round(std_{f}, 4) as std_{f}" for f in SHOWN)}
 from ({baseline_sql()}) b"""))
def entity_baseline(spark, sf_dir):
    b = PR.entity_baseline(_events(spark, sf_dir))
    return b.select("entity", *[F.round(f"{p}_{f}", 4).alias(f"{p}_{f}") for f in SHOWN for p in ("mean", "std")])


def errors_sql() -> str:
    z = " + ".join(f"power(({f} - mean_{f}) / std_{f}, 2)" for f in C.TRAFFIC_FEATURES)
    return f"select r.*, ({z}) / {len(C.TRAFFIC_FEATURES)} as recon_err from rings r join ({baseline_sql()}) b using (entity) where seq >= 15"


@query("reconstruction_error", _seq(f"select event_id, round(recon_err, 4) as recon_err from ({errors_sql()}) e"))
def reconstruction_error(spark, sf_dir):
    e = _events(spark, sf_dir)
    rows = PR.rolling(e, "entity", "ts", "event_id", C.RING_ROWS - 1, PR.add_rings).filter(F.col("seq") >= C.TRAINING_ROWS)
    out = PR.reconstruction_error(rows, PR.entity_baseline(e))
    return out.select("event_id", F.round("recon_err", 4).alias("recon_err"))


def window_sql() -> str:
    return f"""select *, count(*) over w as err_count, min(recon_err) over w as err_min, max(recon_err) over w as err_max,
 quantile_cont(recon_err, 0.98) over w as threshold from ({errors_sql()}) e
 window w as (partition by entity order by seq rows between 99 preceding and current row)"""


def scores_sql() -> str:
    return f"""select *, case when err_count < 10 then 0.0 when err_max-err_min < 1e-8 then case when recon_err > threshold then 0.5 else 0.0 end
 when greatest(least((recon_err-err_min)/(err_max-err_min), 1.0), 0.0) < 1e-10 then 0.0
 else greatest(least((recon_err-err_min)/(err_max-err_min), 1.0), 0.0) end as ind,
 err_count >= 10 and recon_err > threshold as over from ({window_sql()}) w0"""


def _scored(spark, sf_dir, peers: bool = False):
    e = view(spark, sf_dir, "fw")
    groups = portable_groups(e.select(FE.entity_key(e).alias("entity"))) if peers else None
    return dfp.score(e, clock=F.col("ts"), assignments=groups)


@query("rolling_threshold", _seq(f"""select event_id, round(recon_err, 4) as recon_err, round(threshold, 4) as threshold,
 case when over then 1 else 0 end as is_over from ({scores_sql()}) s where err_count >= 10"""))
def rolling_threshold(spark, sf_dir):
    s = _scored(spark, sf_dir).filter(F.col("dfp_detection_method") == "individual_only")
    return s.select("event_id", F.round("recon_err", 4).alias("recon_err"), F.round("threshold", 4).alias("threshold"),
                    F.when(F.col("recon_err") > F.col("threshold"), 1).otherwise(0).alias("is_over"))


@query("individual_score", _seq(f"select event_id, round(ind, 6) as individual_score from ({scores_sql()}) s"))
def individual_score(spark, sf_dir):
    s = _scored(spark, sf_dir).filter(F.col("dfp_status") == "trained")
    return s.select("event_id", F.round("dfp_individual_score", 6).alias("individual_score"))


_AGGS = (("mean", "avg"), ("std", "stddev_pop"), ("max", "max"))


@query("entity_vector", _seq("select entity, count(*) as recent_rows, " + ", ".join(
    f"round({a}({f}), 4)::double as {n}_{f}" for f in SHOWN for n, a in _AGGS) + " from rings where back <= 10 group by entity having count(*) >= 5"))
def entity_vector(spark, sf_dir):
    v = PE.entity_vector(_events(spark, sf_dir))
    return v.select("entity", "recent_rows", *[F.round(f"{n}_{f}", 4).alias(f"{n}_{f}") for f in SHOWN for n, _ in _AGGS])


@query("peer_group_count", with_view("fw", "select count(distinct srcip) as entities, least(greatest(3, count(distinct srcip) // 10), 50)::int as k from fw"))
def peer_group_count(spark, sf_dir):
    n = view(spark, sf_dir, "fw").agg(F.countDistinct("srcip").alias("entities"))
    return n.select("entities", PE.group_count(F.col("entities")).alias("k"))


# Who is with whom is the clustering's matter; that every eligible entity is in one of at most k groups is not.
@query("peer_groups", with_view("fw", """select count(*) as members, count(*) as entities, true as groups_within from (select srcip from fw group by 1 having count(*) >= 5) e"""))
def peer_groups(spark, sf_dir):
    vectors = materialize(PE.entity_vector(_events(spark, sf_dir)), "vectors")
    g = PE.peer_groups(vectors)
    k = vectors.agg(PE.group_count(F.count("*")).alias("k"))
    out = g.agg(F.count("*").alias("members"), F.countDistinct("entity").alias("entities"), F.countDistinct("group_id").alias("n"))
    return out.join(F.broadcast(k), F.col("n") <= F.col("k"), "left").select("members", "entities", F.col("k").isNotNull().alias("groups_within"))


def stats_sql() -> str:
    parts = " union all ".join(
        f"select {_GROUP_SQL} as group_id, '{f}' as feature, entity, {f}::double as value from rings where back <= 10" for f in C.TRAFFIC_FEATURES)
    return f"""select group_id, feature, count(distinct entity)::int as group_size, avg(value) as mean, stddev_pop(value) as std,
 quantile_cont(value, 0.95) as p95 from ({parts}) l group by group_id, feature having count(distinct entity) >= {C.MIN_GROUP_SIZE}"""


@query("peer_stats", _seq(f"select group_id, feature, group_size, round(mean, 4) as mean, round(std, 4) as std, round(p95, 4) as p95 from ({stats_sql()}) s"))
def peer_stats(spark, sf_dir):
    e = _events(spark, sf_dir)
    s = PE.peer_stats(PR.recent_rows(e), portable_groups(e))
    return s.select("group_id", "feature", "group_size", *[F.round(c, 4).alias(c) for c in ("mean", "std", "p95")])


def peer_sql() -> str:
    """event_id -> group and peer score of scored rows."""
    cells = " + ".join(
        f"case when s_{f} < 1e-6 then case when abs({f}-m_{f}) > 1e-6 then 1.0 else 0.0 end else least(abs(({f}-m_{f})/s_{f})/3.0, 1.0) end"
        for f in C.TRAFFIC_FEATURES)
    wide = ", ".join(
        f"max(case when feature='{f}' then mean end) as m_{f}, max(case when feature='{f}' then std end) as s_{f}" for f in C.TRAFFIC_FEATURES)
    return f"""select event_id, g.group_id, g.group_size, ({cells}) / {len(C.TRAFFIC_FEATURES)} as peer
 from rings r join (select group_id, max(group_size) as group_size, {wide} from ({stats_sql()}) s group by group_id) g
 on g.group_id = cast(split_part(r.entity, '.', 4) as int) % {GROUPS}"""


@query("peer_score", _seq(f"select event_id, round(peer, 6) as peer_score from ({peer_sql()}) p"))
def peer_score(spark, sf_dir):
    e = _events(spark, sf_dir)
    groups = portable_groups(e)
    wide = PE.stats_wide(PE.peer_stats(PR.recent_rows(e), groups))
    rows = PR.rolling(e, "entity", "ts", "event_id", C.RING_ROWS - 1, PR.add_rings)
    out = rows.join(groups, "entity").join(F.broadcast(wide), "group_id")
    return out.select("event_id", F.round(PE.peer_score(), 6).alias("peer_score"))


@query("combine_scores", with_view("fw_scored", """select event_id, round(case when p>0 then 0.6*i+0.4*p else i end, 6) as score,
 case when p>0 then (case when 0.6*i+0.4*p > 0.7 or (i>0.8 and p>0.5) or (i>0.5 and p>0.8) then 1 else 0 end) when k%5=0 then 1 else 0 end as is_anomaly
 from (select event_id, k, dfp_individual_score as i, dfp_peer_score as p from fw_scored) s"""))
def combine_scores(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored")
    score, flag = PR.combine_scores(F.col("dfp_individual_score"), F.col("dfp_peer_score"), F.col("k") % 5 == 0)
    return e.select("event_id", F.round(score, 6).alias("score"), flag.alias("is_anomaly"))


def dfp_sql(peers: bool, peer: str | None = None) -> str:
    """The nine result columns of every row, rounded."""
    join = f"left join ({peer or peer_sql()}) p using (event_id)" if peers else "left join (select null::bigint as event_id, null::int as group_id, null::int as group_size, null::double as peer) p using (event_id)"
    return f"""select event_id, case when peer>0 then (case when 0.6*ind+0.4*peer > 0.7 or (ind>0.8 and peer>0.5) or (ind>0.5 and peer>0.8) then 1 else 0 end)
   when over then 1 else 0 end as dfp_is_anomaly,
 round(case when peer>0 then 0.6*ind+0.4*peer else ind end, 6) as dfp_score, round(ind, 6) as dfp_individual_score, round(peer, 6) as dfp_peer_score,
 entity as dfp_entity, status as dfp_status, gid as dfp_peer_group_id, gsize as dfp_peer_group_size,
 case when status <> 'trained' then 'none' when not ok then 'insufficient_history' when peer>0 then 'individual_and_peer' else 'individual_only' end as dfp_detection_method
 from (select event_id, r.entity, case when r.seq >= 15 then 'trained' else 'training' end as status, coalesce(ok, false) as ok, coalesce(ind, 0.0) as ind,
   coalesce(over, false) as over, case when ok then coalesce(peer, 0.0) else 0.0 end as peer, case when ok then p.group_id end::int as gid,
   case when ok then coalesce(p.group_size, 0) else 0 end::int as gsize
   from rings r left join (select event_id, err_count >= 10 as ok, ind, over from ({scores_sql()}) s0) s using (event_id) {join}) d"""


def _dfp_columns(s):
    return s.select("event_id", "dfp_is_anomaly", *[F.round(c, 6).alias(c) for c in ("dfp_score", "dfp_individual_score", "dfp_peer_score")],
                    "dfp_entity", "dfp_status", "dfp_peer_group_id", "dfp_peer_group_size", "dfp_detection_method")


@query("dfp_score", _seq(dfp_sql(True)))
def dfp_score(spark, sf_dir):
    return _dfp_columns(_scored(spark, sf_dir, peers=True))


@query("dfp_score_individual", _seq(dfp_sql(False)))
def dfp_score_individual(spark, sf_dir):
    return _dfp_columns(_scored(spark, sf_dir))


# Rows without an entity; every entity keeps a profile, or, with a cap of 100, the most active ones do.
_PARTIAL = "select event_id, ts, case when event_id%10=0 then '' else srcip end as srcip, dstip, srcport, dstport, proto, action, app, sentbyte, rcvdbyte, sentpkt, rcvdpkt, duration from fw"
CAP = 100


@query("dfp_status", with_view("fw", f"""select event_id, case when srcip='' then 'no_entity'
 when row_number() over (partition by srcip order by ts, event_id) >= 15 then 'trained' else 'training' end as dfp_status from ({_PARTIAL}) q"""))
def dfp_status(spark, sf_dir):
    e = spark.sql(_PARTIAL.replace("from fw", "from {fw}"), fw=view(spark, sf_dir, "fw"))
    return dfp.score(e, clock=F.col("ts")).select("event_id", "dfp_status")


@query("dfp_status_admitted", with_view("fw", f"""select event_id, case when e='' then 'no_entity' when not kept then 'skipped'
 when row_number() over (partition by e order by ts, event_id) >= 15 then 'trained' else 'training' end as dfp_status
 from (select event_id, ts, srcip as e, (srcip in (select srcip from (select srcip, count(*) as n from ({_PARTIAL}) a where srcip<>'' group by 1
   qualify row_number() over (order by count(*) desc, srcip) <= {CAP} and (count(*) over () <= {CAP} or count(*) >= {C.MIN_ENTITY_ROWS})) t)) as kept from ({_PARTIAL}) q) z"""))
def dfp_status_admitted(spark, sf_dir):
    e = spark.sql(_PARTIAL.replace("from fw", "from {fw}"), fw=view(spark, sf_dir, "fw"))
    return dfp.score_admitted(e, CAP, clock=F.col("ts")).select("event_id", "dfp_status")


_VERSIONED = f"""select event_id, total_bytes, {_GROUP_SQL} as group_id, row_number() over (order by ts, event_id) as global_seq,
 row_number() over (order by ts, event_id) // 100 as version from ({feature_sql()}) f"""


@query("refresh_peer_groups", with_view("fw", f"""select event_id, global_seq, version, group_rows, round(s/group_rows, 4) as group_avg_total_bytes
 from (with g as ({_VERSIONED}), run as (select group_id, global_seq, count(*) over w as n, sum(total_bytes) over w as s from g
   window w as (partition by group_id order by global_seq))
 select g.event_id, g.global_seq, g.version, r.n as group_rows, r.s from (select *, version*100 as upto from g) g
 asof left join run r on g.group_id = r.group_id and g.upto >= r.global_seq) x"""))
def refresh_peer_groups(spark, sf_dir):
    e = _events(spark, sf_dir).select("event_id", "ts", "entity", "total_bytes")
    e = e.withColumn("group_id", F.split_part("entity", F.lit("."), F.lit(4)).cast("int") % GROUPS)
    out = PE.refresh_peer_stats(e, ["total_bytes"])
    return out.select("event_id", "global_seq", "version", "group_rows", F.round("group_avg_total_bytes", 4).alias("group_avg_total_bytes"))


# Groups that change: an entity is assigned anew at each refresh that its rows see, at some of them to no group.
EVERY = 250
_MOVING = "case when (octet + version) % 7 = 0 then null else ((octet + version // 2) % 5)::int end"
_GIVEN_SQL = f"""seen as materialized (select r.*, row_number() over (order by ts, event_id) as global_seq, row_number() over (order by ts, event_id) // {EVERY} as version from rings r),
 given as materialized (select entity, version, {_MOVING} as group_id from (select distinct entity, version, split_part(entity, '.', 4)::int as octet from seen) a),
 refreshes as (select distinct version as v from seen where version > 0),
 member as materialized (select * from (select v, entity, group_id from refreshes join given on version <= v qualify row_number() over (partition by v, entity order by version desc) = 1) m0 where group_id is not null),
 live as materialized (select * from (select v, s.* from refreshes join seen s on s.global_seq <= v * {EVERY} qualify row_number() over (partition by v, entity order by seq desc) <= 10) l0),
 sized as materialized (select v, group_id, count(*)::int as group_size from member group by all having count(*) >= {C.MIN_GROUP_SIZE}),
 pool as materialized (select l.*, group_id, group_size from live l join member using (v, entity) join sized using (v, group_id))"""


def _asof_sql(body: str) -> str:
    return with_view("fw", f"select * from (with rings as materialized ({rings_sql()}), {_GIVEN_SQL} {body}) q")


def moving_groups(rows):
    """(entity, version, group_id) at the versions that rows of the entity see."""
    octet = F.split_part("entity", F.lit("."), F.lit(4)).cast("int")
    moved = F.when((octet + F.col("version")) % 7 != 0, ((octet + F.floor(F.col("version") / 2)) % 5).cast("int"))
    return rows.filter(F.col("entity").isNotNull()).select("entity", "version").distinct().withColumn("group_id", moved)


@query("peer_stats_asof", _asof_sql("select * from (" + " union all ".join(
    f"""select v as version, group_id, '{f}' as feature, group_size, round(avg({f}::double), 4) as mean, round(stddev_pop({f}::double), 4) as std,
 round(quantile_cont({f}::double, 0.95), 4) as p95 from pool group by all""" for f in SHOWN) + ") s"))
def peer_stats_asof(spark, sf_dir):
    rows = materialize(PE.versioned(_events(spark, sf_dir), every=EVERY), "versioned")
    s = PV.peer_stats_asof(rows, moving_groups(rows), EVERY, SHOWN)
    return s.select("version", "group_id", "feature", "group_size", *[F.round(c, 4).alias(c) for c in ("mean", "std", "p95")])


def peer_asof_sql() -> str:
    """event_id -> group and peer score against the statistics of the row's own version."""
    cells = " + ".join(
        f"case when s_{f} < 1e-6 then case when abs({f}-m_{f}) > 1e-6 then 1.0 else 0.0 end else least(abs(({f}-m_{f})/s_{f})/3.0, 1.0) end"
        for f in C.TRAFFIC_FEATURES)
    wide = ", ".join(f"avg({f}::double) as m_{f}, stddev_pop({f}::double) as s_{f}" for f in C.TRAFFIC_FEATURES)
    return f"""select event_id, g.group_id, g.group_size, ({cells}) / {len(C.TRAFFIC_FEATURES)} as peer
 from seen r join given using (entity, version) join (select v, group_id, group_size, {wide} from pool group by all) g on g.v = version and g.group_id = given.group_id"""


@query("dfp_score_asof", _asof_sql(dfp_sql(True, peer_asof_sql())))
def dfp_score_asof(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    rows = PE.versioned(e.select("event_id", "ts", FE.entity_key(e).alias("entity")), every=EVERY)
    return _dfp_columns(dfp.score(e, clock=F.col("ts"), assignments=moving_groups(rows), every=EVERY))
