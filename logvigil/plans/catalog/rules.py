"""Rule, alert and message queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import alerts as A
from ...operators import rules as R
from ..views import table
from .registry import query, view, view_sql, with_view

# Scored events as the rule side sees them: a decoder name, the log text and attack classes.
_RULE_EVENTS = """select event_id, ts, srcip, case when k%4<3 then 'threat-ai' when k%8=3 then 'fortigate-traffic' when k%16=7 then 'fortigate-custom' else 'fortigate-greedy' end as decoder,
 case when k%4<3 then case when k%9=8 then 'other' else 'AI-Threat: found' end else concat('action="', action, '" app="', app, '"') end as log,
 case k%8 when 0 then 'sql_injection' when 1 then 'xss_attack' when 2 then 'command_injection' when 3 then 'brute_force' when 4 then 'malware'
  when 5 then 'port_scan' when 6 then 'web_attack' else 'suspicious_activity' end as threat_class,
 confidence, dfp_score, llm_status, llm_is_suspicious, llm_response from fw_scored"""

_BAND = "(decoder='threat-ai' and contains(log, 'AI-Threat:'))"
_TYPES = [(100110, 10, "sql_injection", "SQL Injection attack", "ai,ai_threat_detection,ai_threat,sql_injection,attack"), (100111, 10, "xss_attack", "XSS attack", "ai,ai_threat_detection,ai_threat,xss_attack,attack"),
          (100112, 12, "command_injection", "Command injection attack", "ai,ai_threat_detection,ai_threat,command_injection,attack"), (100113, 9, "brute_force", "Brute force attack", "ai,ai_threat_detection,ai_threat,brute_force,attack"),
          (100114, 13, "malware", "Malware activity", "ai,ai_threat_detection,ai_threat,malware,attack"), (100115, 7, "port_scan", "Port scanning", "ai,ai_threat_detection,ai_threat,port_scan,recon"),
          (100116, 10, "web_attack", "Web attack", "ai,ai_threat_detection,ai_threat,web_attack,attack"), (100117, 6, "suspicious_activity", "Suspicious activity", "ai,ai_threat_detection,ai_threat,suspicious")]
_DESC = "concat('AI: {x} confidence threat detected (', threat_class, ')')"
_RULE_SQL: list[tuple[int, int, str, str, str]] = [
    (100100, 0, "decoder='threat-ai'", "'AI threat detection'", "ai,ai_threat_detection"),
    (100101, 5, f"{_BAND} and confidence >= 0.60 and confidence < 0.75", _DESC.format(x="Low"), "ai,ai_threat_detection,ai_threat,low_confidence"),
    (100102, 8, f"{_BAND} and confidence >= 0.75 and confidence < 0.95", _DESC.format(x="Medium"), "ai,ai_threat_detection,ai_threat,medium_confidence"),
    (100103, 12, f"{_BAND} and confidence >= 0.95", _DESC.format(x="High"), "ai,ai_threat_detection,ai_threat,high_confidence"),
    *[(i, lv, f"{_BAND} and confidence >= 0.60 and threat_class='{c}'", f"concat('AI: {t} detected from ', srcip)", g) for i, lv, c, t, g in _TYPES],
    (100120, 11, f"{_BAND} and confidence >= 0.60 and dfp_score >= 0.8", "concat('AI: High anomaly score detected (', threat_class, ') from ', srcip)", "ai,ai_threat_detection,ai_threat,high_anomaly"),
    (222223, 3, "decoder='fortigate-traffic' and contains(log, 'action=\"accept\"')", "concat('FortiGate: Traffic accepted from ', srcip)", "fortigate,syslog"),
    (222225, 3, "decoder='fortigate-custom' and contains(log, 'app=\"SSH\"')", "concat('FortiGate: SSH session detected from ', srcip)", "fortigate_brute"),
    (222227, 3, "decoder='fortigate-greedy'", "'FortiGate log received.'", "fortigate_fix"),
    (100200, 12, "llm_status='analyzed' and llm_is_suspicious=1 and llm_response<>''", "concat('🚨 LLM-CONFIRMED THREAT: ', llm_response)", "ai,llm_threats,ai_review,threat,suspicious"),
    (100201, 8, "llm_status='analyzed' and llm_is_suspicious=0 and llm_response<>''", "concat('ℹ️ LLM Analysis (Requires Investigation): ', llm_response)", "ai,llm_threats,ai_review,info"),
]


def _fired_sql(ids=None) -> str:
    return " union all ".join(
        f"select event_id, ts, {i} as rule_id, {lv} as rule_level, {d} as rule_description, '{g}' as rule_groups from r where {c}"
        for i, lv, c, d, g in _RULE_SQL if ids is None or i in ids)


def _rules_sql(body: str, ids=None) -> str:
    return f"with fw_scored as ({view_sql('fw_scored', 'duckdb')}), r as ({_RULE_EVENTS}), fired as ({_fired_sql(ids)}) {body}"


def rule_events(spark, sf_dir):
    return spark.sql(_RULE_EVENTS.replace("from fw_scored", "from {e}"), e=view(spark, sf_dir, "fw_scored"))


def fired(spark, sf_dir, ids=None):
    out = R.evaluate_rules(rule_events(spark, sf_dir))
    return out if ids is None else out.filter(F.col("rule_id").isin(list(ids)))


def _rows(df):
    return df.select("event_id", "rule_id", "rule_level", "rule_description", F.array_join("rule_groups", ",").alias("rule_groups"))


_ALL = "select event_id, rule_id, rule_level, rule_description, rule_groups from fired"


def _rule_query(name: str, ids) -> None:
    @query(name, _rules_sql(_ALL, ids))
    def run(spark, sf_dir):
        return _rows(fired(spark, sf_dir, ids))


_rule_query("evaluate_rules", None)
_rule_query("threat_type_rules", [t[0] for t in _TYPES])
_rule_query("high_anomaly_rule", [100120])
_rule_query("substring_rules", [222223, 222225, 222227])
_rule_query("review_rules", [100200, 100201])


@query("suppress_rule", _rules_sql("select event_id, rule_id, rule_level from fired where rule_level > 0"))
def suppress_rule(spark, sf_dir):
    return R.suppress_rule(fired(spark, sf_dir)).select("event_id", "rule_id", "rule_level")


@query("render_description", _rules_sql("select rule_description, count(*) as n from fired group by 1"))
def render_description(spark, sf_dir):
    return fired(spark, sf_dir).groupBy("rule_description").agg(F.count("*").alias("n"))


@query("confidence_band", with_view("fw_scored", """select event_id, case when confidence >= 0.95 then 12 when confidence >= 0.75 then 8 when confidence >= 0.60 then 5 end as level from fw_scored"""))
def confidence_band(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", R.confidence_band(F.col("confidence")).alias("level"))


@query("frequency_rule", with_view("fw_t", """select event_id, n as matches, 222226 as rule_id, 10 as rule_level from (select event_id,
 count(*) over (partition by srcip order by t range between 120 preceding and current row) as n from fw_t where app <> 'SSH' or action='deny') c where n >= 3
 union all select event_id, n, 222224, 10 from (select event_id,
 count(*) over (partition by srcip order by t range between 120 preceding and current row) as n from fw_t where app <> 'SSH' or action='deny') c where n >= 4"""))
def frequency_rule(spark, sf_dir):
    e = view(spark, sf_dir, "fw_t")
    parent = (F.col("app") != "SSH") | (F.col("action") == "deny")
    e = e.withColumn("fired_rules", F.when(parent, F.array(F.lit(222221))).otherwise(F.array().cast("array<int>")))
    rules = tuple(r for r in R.RULES if r.rule_id in (222224, 222226))
    return R.frequency_rules(e, rules=rules).select("event_id", "matches", "rule_id", "rule_level")


_CHANNELS = """select event_id, rule_id, 'alert' as channel from fired where rule_level >= 3
 union all select event_id, rule_id, 'email' from fired where rule_level >= 12 or rule_id = 100200
 union all select event_id, rule_id, 'notification' from fired where rule_id in (100200, 100201)"""


@query("route_alerts", _rules_sql(_CHANNELS))
def route_alerts(spark, sf_dir):
    return R.route_alerts(fired(spark, sf_dir)).select("event_id", "rule_id", "channel")


# Events of about a day per hour slot, so that hours exceed the cap at every scale.
_DAYS = "select event_id, date_trunc('day', ts) as ts from fw_scored"


@query("rate_cap", with_view("fw_scored", f"select event_id, case when row_number() over (partition by ts order by event_id) > 50 then 1 else 0 end as deferred from ({_DAYS}) d"))
def rate_cap(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").select("event_id", F.date_trunc("day", "ts").alias("ts"))
    return R.rate_cap(e).select("event_id", "deferred")


_RESPONSE = (("block", "server", 100112, 180), ("isolate", "all", 100114, 60), ("note", "server", 100200, None))


@query("response_action", _rules_sql("""select f.event_id, f.rule_id, a.command, a.location, a.timeout from fired f join (values ('block','server',100112,180),
 ('isolate','all',100114,60), ('note','server',100200,null)) a(command, location, rule_id, timeout) on a.rule_id = f.rule_id"""))
def response_action(spark, sf_dir):
    return R.response_action(fired(spark, sf_dir), _RESPONSE).select("event_id", "rule_id", "command", "location", "timeout")


@query("severity_level", with_view("fw_scored", """select event_id, case when dfp_is_anomaly=1 and llm_is_suspicious=1 then 14 when llm_is_suspicious=1 and llm_confidence >= 80 then 13
 when llm_is_suspicious=1 then 12 when threat_class<>'normal' then 11 when dfp_is_anomaly=1 then 10 else 8 end as level from fw_scored"""))
def severity_level(spark, sf_dir):
    return view(spark, sf_dir, "fw_scored").select("event_id", R.severity_level().alias("level"))


# Indicators: addresses of the suppliers' and customers' key space.
_IOC = "select concat('10.0.0.', cast(s_suppkey%256 as string)) as indicator, 'malicious-ip' as kind from supplier where s_suppkey%5=0 union select concat('8.8.4.', cast(n_nationkey%8 as string)), 'watched-ip' from nation where n_nationkey%3=0"


@query("ioc_match", with_view("fw_scored", f"""select event_id, 'srcip' as ioc_column, srcip as indicator, kind from fw_scored join ({_IOC}) i on i.indicator = srcip
 union all select event_id, 'dstip', dstip, kind from fw_scored join ({_IOC}) i on i.indicator = dstip"""))
def ioc_match(spark, sf_dir):
    sql = _IOC.replace("from supplier", "from {s}").replace("from nation", "from {n}")
    ioc = spark.sql(sql, s=table(spark, sf_dir, "supplier"), n=table(spark, sf_dir, "nation"))
    return R.ioc_match(view(spark, sf_dir, "fw_scored").select("event_id", "srcip", "dstip"), ioc, ("srcip", "dstip")).select("event_id", "ioc_column", "indicator", "kind")


_CAND = "llm_is_suspicious=1 and llm_response is not null and llm_response<>'' and event_original is not null"


@query("alert_candidates", with_view("fw_scored", f"select event_id, llm_response from fw_scored where {_CAND}"))
def alert_candidates(spark, sf_dir):
    return A.alert_candidates(view(spark, sf_dir, "fw_scored")).select("event_id", "llm_response")


@query("latest_alerts", with_view("fw_scored", f"select event_id, llm_response from fw_scored where {_CAND} order by ts desc, event_id desc limit 10"))
def latest_alerts(spark, sf_dir):
    return A.latest_alerts(view(spark, sf_dir, "fw_scored")).select("event_id", "llm_response")


@query("unseen_alerts", with_view("fw_scored", f"select distinct md5(concat(srcip, dstip)) as doc_id from fw_scored where {_CAND} and md5(concat(srcip, dstip)) not in (select md5(concat(srcip, dstip)) from fw_scored where k%37=5)"))
def unseen_alerts(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").withColumn("doc_id", F.md5(F.concat("srcip", "dstip")))
    return A.unseen_alerts(A.alert_candidates(e), e.filter("k%37=5")).select("doc_id")


_SEV = "case when {c} >= 90 then '{0}' when {c} >= 70 then '{1}' when {c} >= 50 then '{2}' else '{3}' end"


@query("alert_severity", with_view("fw_scored", f"""select event_id, {_SEV.format('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', c='llm_confidence')} as severity,
 cast({_SEV.format(0x8B0000, 0xFF0000, 0xFF6600, 0xFFCC00, c='llm_confidence')} as int) as color,
 concat({_SEV.format('🚨', '⚠️', '⚡', '💡', c='llm_confidence')}, ' AI Alert — ', {_SEV.format('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', c='llm_confidence')}) as title from fw_scored"""))
def alert_severity(spark, sf_dir):
    return A.alert_severity(view(spark, sf_dir, "fw_scored")).select("event_id", "severity", "color", "title")


def _kb(c: str) -> str:
    # hundredths of a KB, halves to even, from whole numbers only
    q, r = f"({c}*100 // 1024)", f"({c}*100 % 1024)"
    h = f"({q} + case when {r} > 512 or ({r} = 512 and {q} % 2 = 1) then 1 else 0 end)"
    return f"concat(cast({h} // 100 as varchar), '.', case when {h} % 10 = 0 then cast({h} % 100 // 10 as varchar) else lpad(cast({h} % 100 as varchar), 2, '0') end)"


@query("format_traffic", with_view("fw_scored", f"select event_id, {_kb('sentbyte')} as sent_kb, {_kb('rcvdbyte')} as received_kb from fw_scored"))
def format_traffic(spark, sf_dir):
    return A.format_traffic(view(spark, sf_dir, "fw_scored")).select("event_id", "sent_kb", "received_kb")


_LINE = lambda label, value: f"concat('**{label}:** `', {value}, '`')"
_RENDER = f"""select event_id, concat({_SEV.format('🚨', '⚠️', '⚡', '💡', c='llm_confidence')}, ' AI Alert — ', {_SEV.format('CRITICAL', 'HIGH', 'MEDIUM', 'LOW', c='llm_confidence')}) as title,
 concat('**🤖 LLM Analysis:**', chr(10), llm_response) as description,
 concat_ws(chr(10), {_LINE('LLM Suspicious', 'cast(llm_is_suspicious as varchar)')}, {_LINE('LLM Confidence', "concat(cast(llm_confidence as varchar), '%')")}, {_LINE('Trigger', 'llm_trigger')}) as signals,
 concat_ws(chr(10), {_LINE('Src', "concat(srcip, ':', cast(srcport as varchar))")}, {_LINE('Dst', "concat(dstip, ':', cast(dstport as varchar))")}, {_LINE('Proto', 'cast(proto as varchar)')},
  {_LINE('App', 'app')}, {_LINE('Action', 'action')}) as network,
 concat_ws(chr(10), {_LINE('Sent', f"concat({_kb('sentbyte')}, ' KB')")}, {_LINE('Received', f"concat({_kb('rcvdbyte')}, ' KB')")}, {_LINE('Duration', 'cast(duration as varchar)')}) as traffic,
 concat_ws(chr(10), {_LINE('Anomaly', "case when dfp_is_anomaly=1 then 'YES ⚠️' else 'NO' end")}, {_LINE('DFP Score', 'cast(dfp_score as varchar)')}, {_LINE('Original Class', 'threat_class')}) as behaviour,
 5 as sections from fw_scored where {_CAND}"""


@query("render_alert", with_view("fw_scored", _RENDER))
def render_alert(spark, sf_dir):
    m = A.render_alert(A.alert_candidates(view(spark, sf_dir, "fw_scored")))
    at = lambda i: F.get("message.fields", F.lit(i))["value"]
    return m.select("event_id", "message.title", "message.description", at(0).alias("signals"), at(1).alias("network"), at(2).alias("traffic"),
                    at(4).alias("behaviour"), F.size("message.fields").alias("sections"))
