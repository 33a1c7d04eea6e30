"""Gating and second-opinion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import detect as D
from ...operators import metrics as M
from ...operators import review as R
from .registry import query, view, view_sql, with_view

_NEED = "((dfp_is_anomaly=1 and dfp_score > 0.98) or confidence < 0.40)"


@query("needs_review", with_view("fw_scored", f"select event_id, case when {_NEED} then 1 else 0 end as needs_review from fw_scored"))
def needs_review(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored")
    return e.select("event_id", R.needs_review(e).cast("int").alias("needs_review"))


def gate_sql(rows: str, key: str, cooldown: int = C.COOLDOWN_SECONDS) -> str:
    """``pass`` (event ids that pass) by a recursive walk from each pass to the next."""
    return f"""gr as materialized (select event_id, t, {key} as gk, row_number() over (partition by {key} order by t, event_id) as rn from {rows}),
 walk as (select gk, event_id, t from gr where rn = 1
  union all select w.gk, n.event_id, n.t from walk w join lateral (select g.event_id, g.t from gr g where g.gk = w.gk and g.t >= w.t + {cooldown}
   order by g.t, g.event_id limit 1) n on true)"""


def _gate(view_name: str, key: str, body: str, extra: str = "") -> str:
    return f"with recursive {view_name} as ({view_sql(view_name, 'duckdb')}), {extra} {gate_sql(view_name, key)} {body}"


@query("cooldown_gate", _gate("fw_t", "srcip", "select v.event_id, case when w.event_id is null then 0 else 1 end as gate_pass from fw_t v left join walk w using (event_id)"))
def cooldown_gate(spark, sf_dir):
    return R.cooldown_gate(view(spark, sf_dir, "fw_t"), ["srcip"]).select("event_id", "gate_pass")


_SIGNATURE = "concat_ws(':', srcip, dstip, cast(dstport as varchar), action, app)"


@query("signature_cooldown", _gate("fw_t", _SIGNATURE, "select v.event_id, case when w.event_id is null then 0 else 1 end as gate_pass from fw_t v left join walk w using (event_id)"))
def signature_cooldown(spark, sf_dir):
    return R.signature_cooldown(view(spark, sf_dir, "fw_t")).select("event_id", "gate_pass")


@query("multi_log_pattern", with_view("fw_t", """select event_id, n as pattern_count, case when n >= 3 then 1 else 0 end as is_pattern from (select event_id,
 count(*) over (partition by srcip order by t range between 120 preceding and current row) as n from fw_t) c"""))
def multi_log_pattern(spark, sf_dir):
    return R.multi_log_pattern(view(spark, sf_dir, "fw_t"), ["srcip"]).select("event_id", "pattern_count", "is_pattern")


@query("review_decision", _gate("fw_t", _SIGNATURE, """select event_id, case when gate_pass=0 then 'skip_same_signature' when n >= 3 then 'analyze_pattern'
 when (k%101)/100.0 > 0.70 then 'analyze_score' else 'skip' end as decision from (select v.event_id, v.k, case when w.event_id is null then 0 else 1 end as gate_pass,
 count(*) over (partition by srcip order by v.t range between 120 preceding and current row) as n from fw_t v left join walk w using (event_id)) d"""))
def review_decision(spark, sf_dir):
    e = view(spark, sf_dir, "fw_t").withColumn("dfp_score", (F.col("k") % 101) / 100)
    return R.review_decision(e).select("event_id", "decision")


# Scored events with the compressed clock.
_TIMED = "select f.*, cast(floor((EPOCH(ts)-1704067200)/100) as bigint) as t from fw_scored f"


def _timed_sql(body: str) -> str:
    timed = _TIMED.replace("EPOCH(ts)", "floor(epoch(ts))")
    return f"""with recursive fw_scored as ({view_sql('fw_scored', 'duckdb')}), timed as ({timed}), need as (select * from timed where {_NEED}),
 {gate_sql('need', 'srcip')}, st as (select v.*, case when not {_NEED} then 'skipped_threshold' when w.event_id is null then 'skipped_cooldown' else 'analyzed' end as status
 from timed v left join walk w using (event_id)) {body}"""


def timed(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").drop("llm_status", "llm_is_suspicious", "llm_confidence", "llm_response", "llm_trigger")
    sql = _TIMED.replace("EPOCH(ts)", "unix_timestamp(cast(ts as timestamp))").replace("fw_scored f", "{e} f")
    return spark.sql(sql, e=e)


@query("review_status", _timed_sql(f"""select event_id, status as llm_status, case status when 'skipped_threshold' then 0 when 'skipped_cooldown' then 1 end as llm_is_suspicious,
 case when status='skipped_cooldown' then '{C.COOLDOWN_REASON}' end as llm_reason from st"""))
def review_status(spark, sf_dir):
    return R.review_status(timed(spark, sf_dir)).select("event_id", "llm_status", "llm_is_suspicious", "llm_reason")


@query("enrichment_record", with_view("fw_scored", """select event_id, cast(ts as varchar) as "@timestamp", srcip, dstip, threat_class as original_threat_class, dfp_is_anomaly, dfp_score,
 '2024-02-01T07:30:00+07:00' as enrichment_timestamp, llm_confidence, llm_response, llm_trigger from fw_scored"""))
def enrichment_record(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").withColumn("@timestamp", F.col("ts").cast("string"))
    rec = R.enrichment_record(e.drop("llm_status", "llm_is_suspicious", "confidence"), F.lit("2024-02-01 00:30:00").cast("timestamp"))
    return rec.select("event_id", "@timestamp", "srcip", "dstip", "original_threat_class", "dfp_is_anomaly", "dfp_score", "enrichment_timestamp", "llm_confidence", "llm_response", "llm_trigger")


@query("review_trigger", with_view("fw_scored", "select event_id, case when dfp_is_anomaly=1 then 'dfp_anomaly' else 'low_bert_conf' end as trigger_name from fw_scored"))
def review_trigger(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", D.review_trigger().alias("trigger_name"))


def reviewed(spark, sf_dir):
    """Gate, analyze the rows that pass, and put all rows together again."""
    s = R.review_status(timed(spark, sf_dir))
    go = s.filter("llm_status = 'analyzed'")
    go = R.attach_verdict(R.analyze(go.withColumn("prompt", D.render_prompt(go, "review")))).drop("prompt")
    return s.filter("llm_status <> 'analyzed'").unionByName(go, allowMissingColumns=True)


_BAD = "(action='deny' or dstport=22)"


@query("analyze", _timed_sql(f"""select event_id, case when {_BAD} then 1 else 0 end as llm_is_suspicious, case when {_BAD} then 85 else 15 end::bigint as llm_confidence,
 case when {_BAD} then 'matches a known risk' else 'ordinary traffic' end as llm_response, case when dfp_is_anomaly=1 then 'dfp_anomaly' else 'low_bert_conf' end as llm_trigger
 from st where status='analyzed'"""))
def analyze(spark, sf_dir):
    return reviewed(spark, sf_dir).filter("llm_status = 'analyzed'").select("event_id", "llm_is_suspicious", "llm_confidence", "llm_response", "llm_trigger")


@query("review_metrics", _timed_sql(f"""select count(*) as consumed, count_if(status='analyzed')::bigint as analyzed, count_if(status='skipped_cooldown')::bigint as skipped_cooldown,
 count_if(status='skipped_threshold')::bigint as skipped_threshold, count_if(status='analyzed' and {_BAD})::bigint as threats, round(count_if(status='analyzed')*100.0/count(*), 4) as analysis_rate from st"""))
def review_metrics(spark, sf_dir):
    return M.review_metrics(reviewed(spark, sf_dir))
