"""The chain from raw lines to verdicts, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...session import materialize
from .. import chain
from .detect import category_sql, classify_sql
from .parsing import _field, _lines_sql
from .profile import dfp_sql, rings_sql
from .registry import query, view
from .review import _BAD, gate_sql

_FIELDS = ["date", "time", "srcip", "dstip", "srcport", "dstport", "proto", "action", "app", "sentbyte", "rcvdbyte"]
_NUM = lambda c: f"coalesce(try_cast({c} as bigint), 0) as {c}"

# Fields of the lines, scored where the line has a source; then the text decides.
_DETECT = f"""fields as (select event_id, {', '.join(_field(c) for c in _FIELDS)} from kv group by event_id),
 fw as (select event_id, try_cast(concat(date, ' ', time) as timestamp) - interval 7 hour as ts, srcip, dstip, {_NUM('srcport')}, {_NUM('dstport')}, {_NUM('proto')}, action, app,
  {_NUM('sentbyte')}, {_NUM('rcvdbyte')}, 0 as sentpkt, 0 as rcvdpkt, 0 as duration from fields where srcip is not null),
 rings as ({rings_sql()}), scored as ({dfp_sql(False)}),
 h as (select r.event_id, concat('Rule:  Level: 0 Action:  Service:  Log: ', r.value) as text, coalesce(s.dfp_is_anomaly, 0) as dfp_is_anomaly, coalesce(s.dfp_score, 0.0) as dfp_score,
  coalesce(s.dfp_status, 'no_entity') as dfp_status, f.srcip, f.action, f.dstport, cast(floor((epoch(f.ts) - 1704067200) / 100) as bigint) as t
  from raw_lines r left join scored s using (event_id) left join fw f using (event_id)),
 hits as (select *, {category_sql('text')} as cat from h),
 res as (select event_id, cat as threat_class, 0.95::double as confidence, 1 as is_threat, 'regex' as stages_used, dfp_is_anomaly, dfp_score, dfp_status, srcip, action, dstport, t from hits where cat is not null
  union all select event_id, threat_class, confidence, case when threat_class <> 'normal' or (dfp_is_anomaly = 1 and dfp_score > 0.70) then 1 else 0 end, 'bert → dfp', dfp_is_anomaly, dfp_score, dfp_status, srcip, action, dstport, t
  from ({classify_sql("(select * from hits where cat is null)", 'text')}) c)"""


def _chain_sql(body: str, more: str = "") -> str:
    sql = _lines_sql("|").rstrip("|")
    return f"{sql.replace('with raw_lines', 'with recursive raw_lines', 1)}, {_DETECT}{more} {body}"


@query("pipeline_detect", _chain_sql("select event_id, threat_class, round(confidence, 6) as confidence, is_threat, stages_used, dfp_is_anomaly, round(dfp_score, 6) as dfp_score, dfp_status from res"))
def pipeline_detect(spark, sf_dir):
    r = chain.detect(view(spark, sf_dir, "raw_lines"))
    return r.select("event_id", "threat_class", F.round("confidence", 6).alias("confidence"), "is_threat", "stages_used", "dfp_is_anomaly", F.round("dfp_score", 6).alias("dfp_score"), "dfp_status")


_NEED = "((dfp_is_anomaly=1 and dfp_score > 0.98) or confidence - 0.005 < 0.40)"


@query("pipeline_review", _chain_sql(f"""select event_id, case when not {_NEED} then 'skipped_threshold' when w.event_id is null then 'skipped_cooldown' else 'analyzed' end as llm_status,
 case when not {_NEED} then 0 when w.event_id is null then 1 when {_BAD} then 1 else 0 end as llm_is_suspicious,
 case when {_NEED} and w.event_id is not null then case when {_BAD} then 85 else 15 end end::bigint as llm_confidence from r1 left join walk w using (event_id)""",
    f", r1 as (select event_id, coalesce(srcip, '') as srcip, coalesce(t, 0) as t, coalesce(action, '') as action, dstport, confidence, dfp_is_anomaly, dfp_score from res), need as (select * from r1 where {_NEED}), {gate_sql('need', 'srcip')}"))
def pipeline_review(spark, sf_dir):
    r = chain.detect(view(spark, sf_dir, "raw_lines"))
    clock = F.coalesce(F.floor((F.unix_seconds("ts") - 1704067200) / 100), F.lit(0)).cast("bigint")
    # a classifier that is unsure below 0.405 makes the ordinary lines worth a second look
    r = materialize(r.withColumns({"t": clock, "confidence": F.col("confidence") - 0.005}), "results")
    out = chain.review(r, "t")
    return out.select("event_id", "llm_status", "llm_is_suspicious", F.col("llm_confidence").cast("bigint").alias("llm_confidence"))
