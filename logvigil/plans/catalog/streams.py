"""Streaming and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import alerts as A
from ...operators import metrics as M
from ...operators import models as MO
from ...operators import peers as PE
from ...operators import profile as PR
from ...session import materialize, scratch_path
from ...sources import io
from ...streaming import gates, profile_stream
from ...streaming.sources import drain, table_stream
from .. import dfp
from ..views import _escape, utc
from .profile import SHOWN, _dfp_columns, _events, _seq, dfp_sql, portable_groups
from .registry import query, view, view_sql, with_view
from .review import _gate


def stream_view(spark, sf_dir, name):
    """A derived view over the events as a stream."""
    sql = _escape(view_sql(name, "spark")).replace("from events", "from {events}")
    return spark.sql(sql, events=table_stream(utc(spark), sf_dir, "events"))


@query("dfp_score_stream", _seq(dfp_sql(True)))
def dfp_score_stream(spark, sf_dir):
    e = _events(spark, sf_dir)
    groups = materialize(portable_groups(e), "groups")
    stats = materialize(PE.peer_stats(PR.recent_rows(e), groups, p95=False), "stats")
    out = profile_stream.score_stream(stream_view(spark, sf_dir, "fw"), clock=F.col("ts"), assignments=groups, stats=stats)
    return _dfp_columns(drain(out, "dfp"))


def _timed_stream(spark, sf_dir):
    e = stream_view(spark, sf_dir, "fw_t")
    return e.withColumn("ts", F.timestamp_seconds(F.col("t") + 1704067200))


@query("cooldown_gate_stream", _gate("fw_t", "srcip", "select v.event_id, case when w.event_id is null then 0 else 1 end as gate_pass from fw_t v left join walk w using (event_id)"))
def cooldown_gate_stream(spark, sf_dir):
    return drain(gates.cooldown_gate_stream(_timed_stream(spark, sf_dir), ["srcip"]), "gate").select("event_id", "gate_pass")


@query("cooldown_state_cap", _gate("fw_t", "srcip", "select v.srcip, count(*) as passes from fw_t v join walk w using (event_id) group by 1"))
def cooldown_state_cap(spark, sf_dir):
    """State is bounded by time-to-live instead of a capped cache; passes per key must not change."""
    g = drain(gates.cooldown_gate_stream(_timed_stream(spark, sf_dir), ["srcip"]), "gate")
    return g.filter("gate_pass = 1").groupBy("srcip").agg(F.count("*").alias("passes"))


@query("frequency_rule_stream", with_view("fw_t", """select event_id, n as matches from (select event_id,
 count(*) over (partition by srcip order by t range between 120 preceding and current row) as n from fw_t) c where n >= 3"""))
def frequency_rule_stream(spark, sf_dir):
    return drain(gates.frequency_rule_stream(_timed_stream(spark, sf_dir), ["srcip"], 3, 120), "frequency").select("event_id", "matches")


@query("unseen_alerts_stream", with_view("fw_scored", """select distinct md5(concat(srcip, dstip)) as doc_id from fw_scored
 where llm_is_suspicious=1 and llm_response is not null and llm_response<>'' and event_original is not null"""))
def unseen_alerts_stream(spark, sf_dir):
    e = stream_view(spark, sf_dir, "fw_scored").withColumns({"doc_id": F.md5(F.concat("srcip", "dstip")), "ts": F.col("ts").cast("timestamp")})
    path = scratch_path(spark, "alerts")
    alerts = A.alert_candidates(e).select("doc_id", "ts")
    for checkpoint in ("-one", "-two"):  # the second one finds all ids sent
        gates.unseen_to(alerts, path, path + checkpoint, available_now=True).awaitTermination()
    return gates.sent_ids(spark, path, alerts.schema).read().select("doc_id")


# Two checkpoints write to one store, one of them is started twice; the parts are then compacted.
@query("index_append", with_view("fw_scored", "select event_id, srcip, dfp_score from fw_scored union all select event_id, srcip, dfp_score from fw_scored"))
def index_append(spark, sf_dir):
    path = scratch_path(spark, "index")
    e = stream_view(spark, sf_dir, "fw_scored").select("event_id", "srcip", "dfp_score", "ts")
    day = F.to_date("ts")
    for checkpoint in ("-one", "-two", "-one"):
        io.index_append(e, path, path + checkpoint, day, available_now=True).awaitTermination()
    store = io.event_store(spark, path, e.schema, day)
    store.compact(2)
    return store.read().select("event_id", "srcip", "dfp_score")


@query("index_metrics", with_view("fw_scored", "select count(llm_response) as indexed, count(*) - count(llm_response) as errors from fw_scored"))
def index_metrics(spark, sf_dir):
    path, counts = scratch_path(spark, "index"), []
    e = stream_view(spark, sf_dir, "fw_scored").select("event_id", "llm_response")
    q = io.index_append(e, path, path + "-checkpoint", required=("llm_response",), available_now=True, on_batch=lambda batch, stored, refused: counts.append(refused))
    q.awaitTermination()
    return io.event_store(spark, path, e.schema).read().agg(F.count("*").alias("indexed"), F.lit(sum(counts)).cast("bigint").alias("errors"))


@query("deliver_alerts", with_view("fw_scored", "select event_id, llm_response from fw_scored where llm_is_suspicious=1 and llm_response is not null and llm_response<>'' and event_original is not null"))
def deliver_alerts(spark, sf_dir):
    path = scratch_path(spark, "delivered")
    alerts = A.alert_candidates(stream_view(spark, sf_dir, "fw_scored")).select("event_id", "llm_response")
    io.deliver_alerts(alerts, lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}"), path + "-checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(path).select("event_id", "llm_response")


# Complete output: the window that is still open is there as well.
@query("throughput_stream", "select cast(date_trunc('day', ts)::timestamp as varchar) as window_start, count(*) as messages from events group by 1")
def throughput_stream(spark, sf_dir):
    e = table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = drain(M.throughput(e, width="1 day"), "throughput", "complete")
    return out.select(F.col("window_start").cast("string").alias("window_start"), "messages")


# The weights are beyond SQL; the scaling that a model carries is not, and says which rows it was trained on.
@query("train_autoencoder", _seq(f"""select entity, {MO.parameter_count()}::int as parameters, {", ".join(
    f"round(avg({f}::double), 4) as mean_{f}, round(case when stddev_pop({f}::double) < 1e-6 then 1.0 else stddev_pop({f}::double) end, 4) as std_{f}" for f in SHOWN)}
 from rings where seq <= 15 group by entity having count(*) = 15"""))
def train_autoencoder(spark, sf_dir):
    m = MO.train_models(_events(spark, sf_dir))
    at = lambda i: F.round(F.get("params", F.lit(i)), 4)
    width, place = len(C.TRAFFIC_FEATURES), C.TRAFFIC_FEATURES.index
    return m.select("entity", F.size("params").alias("parameters"), *[at(place(f) + shift).alias(f"{name}_{f}") for f in SHOWN for name, shift in (("mean", 0), ("std", width))])


# A model's errors are beyond SQL; what must hold of every row is not: number, status, method and the range of its score.
_MODELLED = with_view("fw", """select event_id, seq, case when seq >= 15 then 'trained' else 'training' end as dfp_status,
 case when seq < 15 then 'none' when seq < 24 then 'insufficient_history' else 'individual_only' end as dfp_detection_method, true as in_range
 from (select event_id, row_number() over (partition by srcip order by ts, event_id) as seq from fw) s""")


def _modelled(spark, sf_dir, scorer):
    s = dfp.score(view(spark, sf_dir, "fw"), clock=F.col("ts"), scorer=scorer)
    return s.select("event_id", F.col("seq").cast("bigint").alias("seq"), "dfp_status", "dfp_detection_method", F.col("dfp_score").between(0, 1).alias("in_range"))


@query("dfp_score_autoencoder", _MODELLED)
def dfp_score_autoencoder(spark, sf_dir):
    return _modelled(spark, sf_dir, "autoencoder")


@query("dfp_score_pca", _MODELLED)
def dfp_score_pca(spark, sf_dir):
    return _modelled(spark, sf_dir, "pca")


