"""Signature, classification and decision queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import detect as D
from ...operators import metrics as M
from ..views import table
from .registry import query, view, with_view

_TEXT = """concat('Rule: ', rule_id, ' Level: ', cast(rule_level as varchar), ' Action: ', fortinet_action,
 ' Service: ', fortinet_service, ' Log: ', full_log)"""
_CUT = _TEXT.replace("full_log)", "substring(full_log, 1, 300))")
# A tenth of the logs says what it says behind the first 300 characters.
_LONG = "case when {t}event_id%10=3 then concat(repeat('traffic forward close ', 20), {t}full_log) else {t}full_log end"


def _hit(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, '{pattern}', 'i')"


def signature_case(col: str, values: list[str]) -> str:
    """CASE over the signatures in order, giving one of ``values`` per signature."""
    return "case " + " ".join(f"when {_hit(col, p)} then {v}" for (_, p), v in zip(C.SIGNATURES, values)) + " end"


def category_sql(col: str) -> str:
    return signature_case(col, [f"'{c}'" for c, _ in C.SIGNATURES])


def _match_sql(source: str, key: str, col: str) -> str:
    pattern = signature_case(col, [f"'{p}'" for _, p in C.SIGNATURES])
    return f"""select {key}, {category_sql(col)} as regex_category, {pattern} as regex_pattern,
 case when {category_sql(col)} is not null then 0.95::double end as regex_confidence from {source}"""


_LONG_LOG = f"select event_id, rule_id, rule_level, fortinet_action, fortinet_service, {_LONG.format(t='')} as full_log from fw_log"


@query("detection_text", with_view("fw_log", f"select event_id, {_CUT} as text from ({_LONG_LOG}) l"))
def detection_text(spark, sf_dir):
    e = spark.sql(_LONG_LOG.replace("from fw_log", "from {log}"), log=view(spark, sf_dir, "fw_log"))
    return e.select("event_id", D.detection_text(e, chars=C.LOG_CHARS).alias("text"))


_SHOWN = ["regex_category", "regex_pattern", "regex_confidence"]


@query("signature_match", with_view("fw_log", _match_sql("fw_log", "event_id", "full_log")))
def signature_match(spark, sf_dir):
    return D.signature_match(view(spark, sf_dir, "fw_log"), "full_log").select("event_id", *_SHOWN)


@query("signature_documents", _match_sql("documents", "doc_id", "text"))
def signature_documents(spark, sf_dir):
    return D.signature_match(table(spark, sf_dir, "documents"), "text").select("doc_id", *_SHOWN)


@query("signature_pages", _match_sql("pages", "page_id", "html"))
def signature_pages(spark, sf_dir):
    return D.signature_match(table(spark, sf_dir, "pages"), "html").select("page_id", *_SHOWN)


def _all_sql() -> str:
    cats: dict[str, list[str]] = {}
    for c, p in C.SIGNATURES:
        cats.setdefault(c, []).append(p)
    cells = ", ".join(f"case when {' or '.join(_hit('full_log', p) for p in ps)} then '{c}' end" for c, ps in cats.items())
    return f"select event_id, concat_ws(',', {cells}) as categories from fw_log"


@query("signature_all", with_view("fw_log", _all_sql()))
def signature_all(spark, sf_dir):
    e = view(spark, sf_dir, "fw_log")
    return e.select("event_id", F.array_join(D.signature_all(F.col("full_log")), ",").alias("categories"))


def logits_sql(col: str) -> str:
    cells = ["1.0::double"]
    for label in (1, 2, 3, 4):
        cells.append(" + ".join(f"case when contains(lower({col}), '{w}') then 2.0 else 0.0 end" for w in D._CUES[label]) + "")
    return "[" + ", ".join(f"({c})::double" for c in cells) + "]"


def classify_sql(source: str, col: str) -> str:
    """source with class_id, threat_class and confidence of the stand-in model."""
    labels = ", ".join(f"'{x}'" for x in C.LABELS)
    return f"""select *, [{labels}][class_id+1] as threat_class from (select *, (list_position(lg, list_max(lg)) - 1)::int as class_id,
 1.0 / list_sum([exp(x - list_max(lg)) for x in lg]) as confidence from (select *, {logits_sql(col)} as lg from {source}) l0) l1"""


@query("classify", with_view("fw_log", f"select event_id, class_id, threat_class, round(confidence, 6) as confidence from ({classify_sql('fw_log', 'full_log')}) c"))
def classify(spark, sf_dir):
    c = D.classify(view(spark, sf_dir, "fw_log").select("event_id", "full_log"), "full_log")
    return c.select("event_id", "class_id", "threat_class", F.round("confidence", 6).alias("confidence"))


_LOGITS = "[(k%7)*0.5, (k%5)*0.5, (k%3)*1.0, (k%11)*0.25, (k%2)*1.5]"


@query("softmax_argmax", with_view("fw_scored", f"""select event_id, (list_position(lg, list_max(lg)) - 1)::int as class_id,
 round(1.0 / list_sum([exp(x - list_max(lg)) for x in lg]), 6) as confidence, round(exp(lg[1] - list_max(lg)) / list_sum([exp(x - list_max(lg)) for x in lg]), 6) as p0
 from (select event_id, {_LOGITS}::double[] as lg from fw_scored) l"""))
def softmax_argmax(spark, sf_dir):
    k = F.col("k")
    lg = F.array((k % 7) * 0.5, (k % 5) * 0.5, (k % 3) * 1.0, (k % 11) * 0.25, (k % 2) * 1.5)
    s = D.softmax_argmax(view(spark, sf_dir, "fw_scored").select("event_id", lg.alias("logits")))
    return s.select("event_id", "class_id", F.round("confidence", 6).alias("confidence"), F.round(F.get("probs", F.lit(0)), 6).alias("p0"))


@query("label_lookup", with_view("fw_scored", """select event_id, case k%7 when 0 then 'normal' when 1 then 'DoS' when 2 then 'PortScan'
 when 3 then 'Malware' when 4 then 'BruteForce' else 'unknown' end as label from fw_scored"""))
def label_lookup(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", D.label_lookup(F.col("k") % 7).alias("label"))


# Signature log lines joined with the behaviour scores of the same events, both derived from events.
_HYBRID = "select l.event_id, l.ts, " + _LONG.format(t="l.") + """ as full_log, l.rule_id, l.rule_level, l.fortinet_action, l.fortinet_service,
 s.dfp_is_anomaly, s.dfp_score, s.dfp_individual_score, s.dfp_peer_score, s.dfp_peer_group_id, s.dfp_detection_method as dfp_method_in
 from fw_log l join fw_scored s on l.event_id = s.event_id"""


def _hybrid_sql(body: str) -> str:
    from .registry import view_sql

    return f"""with fw_log as ({view_sql('fw_log', 'duckdb')}), fw_scored as ({view_sql('fw_scored', 'duckdb')}), h as (select *, {_TEXT} as text from ({_HYBRID}) h0),
 hits as (select *, {category_sql('text')} as cat from h),
 res as (select event_id, cat as threat_class, 0.95::double as confidence, 1 as is_threat, 'regex' as stages_used, 'regex_pattern' as detection_method,
  dfp_is_anomaly, dfp_score, dfp_individual_score, dfp_peer_score, dfp_method_in from hits where cat is not null
 union all select event_id, threat_class, confidence, case when threat_class <> 'normal' or (dfp_is_anomaly = 1 and dfp_score > 0.70) then 1 else 0 end,
  'bert → dfp', null, dfp_is_anomaly, dfp_score, dfp_individual_score, dfp_peer_score, dfp_method_in
  from ({classify_sql("(select * from hits where cat is null)", 'text')}) c) {body}"""


def hybrid(spark, sf_dir):
    """Cascade and decision over the joined log lines."""
    log, scored = view(spark, sf_dir, "fw_log"), view(spark, sf_dir, "fw_scored")
    h = spark.sql(_HYBRID.replace("fw_log l", "{log} l").replace("fw_scored s", "{scored} s"), log=log, scored=scored)
    h = h.withColumn("text", D.detection_text(h))
    return D.threat_result(D.cascade(h))


@query("cascade", _hybrid_sql("select event_id, threat_class, round(confidence, 6) as confidence, stages_used from res"))
def cascade(spark, sf_dir):
    return hybrid(spark, sf_dir).select("event_id", "threat_class", F.round("confidence", 6).alias("confidence"), "stages_used")


@query("threat_result", _hybrid_sql("""select event_id, threat_class, round(confidence, 6) as confidence, is_threat, stages_used, detection_method,
 'hybrid_dfp_peer_v2' as model_version, dfp_is_anomaly, dfp_score, 'unknown' as dfp_status, 0 as dfp_peer_group_size, 'none' as dfp_detection_method from res"""))
def threat_result(spark, sf_dir):
    return hybrid(spark, sf_dir).select("event_id", "threat_class", F.round("confidence", 6).alias("confidence"), "is_threat", "stages_used",
                                        "detection_method", "model_version", "dfp_is_anomaly", "dfp_score", "dfp_status", "dfp_peer_group_size", "dfp_detection_method")


_TRIGGER = """case when dfp_is_anomaly = 1 then case when {m} = 'individual_and_peer' then 'both' when dfp_peer_score > dfp_individual_score then 'peer' else 'individual' end end"""


@query("detection_metrics", _hybrid_sql(f"""select count(*) as total, count_if(stages_used='regex')::bigint as regex_hits, count_if(stages_used<>'regex')::bigint as classified,
 count_if(is_threat=1)::bigint as threats, round(count_if(is_threat=1)*100.0/count(*), 4) as threat_pct,
 {", ".join(f"count_if(stages_used<>'regex' and {_TRIGGER.format(m='dfp_method_in')}='{s}')::bigint as dfp_{s}" for s in ("individual", "peer", "both"))} from res"""))
def detection_metrics(spark, sf_dir):
    r = hybrid(spark, sf_dir)
    return M.detection_metrics(r.withColumn("dfp_detection_method", F.col("dfp_method_in")))


@query("threat_decision", with_view("fw_scored", """select event_id, case when threat_class <> 'normal' then 1 else 0 end as classifier_threat,
 case when dfp_is_anomaly=1 and dfp_score > 0.70 then 1 else 0 end as dfp_threat,
 case when threat_class <> 'normal' or (dfp_is_anomaly=1 and dfp_score > 0.70) then 1 else 0 end as is_threat from fw_scored"""))
def threat_decision(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select(
        "event_id", D.classifier_threat().cast("int").alias("classifier_threat"), D.dfp_threat().cast("int").alias("dfp_threat"),
        D.threat_decision().alias("is_threat"))


@query("anomaly_trigger", with_view("fw_scored", f"select event_id, {_TRIGGER.format(m='dfp_detection_method')} as source from fw_scored"))
def anomaly_trigger(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", D.anomaly_trigger().alias("source"))


@query("threat_reasons", with_view("fw_scored", """select event_id, concat_ws(' | ', case when threat_class <> 'normal' then concat('BERT:', threat_class) end,
 case when dfp_is_anomaly=1 and dfp_score > 0.70 then printf('DFP:%.2f(ind=%.2f,peer=%.2f,group=%s)', dfp_score, dfp_individual_score, dfp_peer_score,
 coalesce(cast(dfp_peer_group_id as varchar), 'None')) end) as reasons from fw_scored"""))
def threat_reasons(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", D.threat_reasons().alias("reasons"))


_SERVICE = "case " + " ".join(f"when {{p}}={k} then '{v}'" for k, v in C.SERVICE_NAMES.items()) + " else concat('port ', cast({p} as varchar)) end"
_PROTO = "case " + " ".join(f"when {{p}}={k} then '{v}'" for k, v in C.PROTOCOL_NAMES.items()) + " else concat('Protocol ', cast({p} as varchar)) end"


@query("service_name", with_view("fw_scored", f"select event_id, {_SERVICE.format(p='(k%60)')} as service, {_PROTO.format(p='(k%20)')} as protocol from fw_scored"))
def service_name(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select(
        "event_id", D.service_name(F.col("k") % 60).alias("service"), D.protocol_name(F.col("k") % 20).alias("protocol"))


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_REVIEW_LINES = [("Source IP", "srcip"), ("Destination IP", "dstip"), ("Source Port", "srcport"), ("Destination Port", "dstport"), ("Protocol", "proto"),
                 ("Action", "action"), ("Application", "app"), ("Bytes Sent", "sentbyte"), ("Bytes Received", "rcvdbyte")]
_REVIEW = "concat(" + _quote(D.REVIEW_INSTRUCTION + "\n\nLOG DATA:") + ", " + ", ".join(
    f"{_quote(chr(10) + '- ' + label + ': ')}, cast({c} as varchar)" for label, c in _REVIEW_LINES) + ")"
_DETECTOR = f"""concat({_quote(D.DETECTOR_SYSTEM + chr(10) * 2)}, case when dfp_is_anomaly=1 then concat('ALERT: DFP BEHAVIOURAL ANOMALY (score: ', cast(cast(round(dfp_score*100) as bigint) as varchar),
 {_quote("%)" + chr(10) + "Entity behaviour differs significantly from baseline and/or peer group.")})
 else {_quote("ALERT: LOW CONFIDENCE DETECTION" + chr(10) + "ML classifier uncertain about this traffic pattern.")} end,
 {_quote(chr(10) * 2 + "NETWORK LOG:" + chr(10))}, srcip, ':', cast(srcport as varchar), ' → ', dstip, ':', cast(dstport as varchar),
 {_quote(chr(10) + "Protocol: ")}, {_PROTO.format(p='proto')}, {_quote(chr(10) + "Service: ")}, {_SERVICE.format(p='dstport')},
 {_quote(chr(10) + "Action: ")}, action, {_quote(chr(10) + "Data: ")}, cast(sentbyte as varchar), 'B sent, ', cast(rcvdbyte as varchar),
 {_quote("B received" + chr(10) * 2 + "TASK: Is this malicious traffic?" + chr(10) + D.DETECTOR_FORMAT)})"""


@query("render_prompt", with_view("fw_scored", f"select event_id, {_REVIEW} as review_prompt, {_DETECTOR} as detector_prompt from fw_scored"))
def render_prompt(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored")
    return e.select("event_id", D.render_prompt(e, "review").alias("review_prompt"), D.render_prompt(e, "detector").alias("detector_prompt"))


_WORDS = " or ".join(f"contains(lower(answer), '{w}')" for w in C.VERDICT_KEYWORDS)
_DWORDS = " or ".join(f"contains(lower(answer), '{w}')" for w in C.DETECTOR_KEYWORDS)


@query("parse_verdict", with_view("answers", f"""select event_id, case form when 'keywords' then ({_WORDS})::int when 'broken' then contains(lower(answer), 'true')::int
  when 'json' then (flag='true')::int else 0 end as verdict_threat,
 case form when 'keywords' then case when {_WORDS} then 80 else 20 end when 'broken' then case when contains(lower(answer), 'true') then 70 else 30 end
  when 'json' then coalesce(try_cast(conf as bigint), 50) else 0 end::bigint as verdict_confidence,
 case form when 'json' then coalesce(reason, case when not regexp_matches(obj, '"reason"\\s*:') then 'No reason provided' end) when 'error' then concat('error: confidence is not a number: ', conf) else answer end as verdict_reason,
 case when form='error' then 'error' when dfp_is_anomaly=1 then 'dfp_anomaly' else 'low_bert_conf' end as verdict_trigger
 from (select *, case when obj='' then 'keywords' when not json_valid(obj) then 'broken' when conf is not null and try_cast(conf as bigint) is null then 'error' else 'json' end as form
 from (select *, case when json_valid(obj) then obj->>'$.is_threat' end as flag, case when json_valid(obj) then obj->>'$.confidence' end as conf,
  case when json_valid(obj) then obj->>'$.reason' end as reason
 from (select *, regexp_extract(answer, '\\{{[^}}]*"is_threat"[^}}]*\\}}', 0) as obj from answers) a0) a1) a2"""))
def parse_verdict(spark, sf_dir):
    return D.parse_verdict(view(spark, sf_dir, "answers")).select("event_id", "verdict_threat", "verdict_confidence", "verdict_reason", "verdict_trigger")


@query("parse_verdict_keywords", with_view("answers", f"""select event_id, ({_DWORDS})::int as verdict_threat,
 coalesce(try_cast(regexp_extract(answer, '"confidence":\\s*([0-9]+)', 1) as bigint), case when {_DWORDS} then 75 else 50 end)::bigint as verdict_confidence,
 case when dfp_is_anomaly=1 then 'dfp_anomaly' else 'low_bert_confidence' end as verdict_trigger from answers"""))
def parse_verdict_keywords(spark, sf_dir):
    return D.parse_verdict_keywords(view(spark, sf_dir, "answers")).select("event_id", "verdict_threat", "verdict_confidence", "verdict_trigger")
