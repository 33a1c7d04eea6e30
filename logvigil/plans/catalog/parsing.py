"""Raw text to events: parsing, decoding, files and label lookups."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import parse as P
from ...session import scratch_path
from ...sources import io
from .registry import query, view, view_sql, with_view

_PRI = "regexp_matches(value, '^<[^>]*>')"
_PAYLOAD = f"case when {_PRI} then regexp_extract(value, '^<([^>]*)>(.*)$', 2) end"
_KV = """select event_id, regexp_replace(k, '"', '', 'g') as key, trim(v, '"') as val from (select event_id, unnest(regexp_extract_all(payload, '([^ =]+)=("[^"]*"|[^ ]*)', 1)) as k,
 unnest(regexp_extract_all(payload, '([^ =]+)=("[^"]*"|[^ ]*)', 2)) as v from p) x group by all"""


def _lines_sql(body: str) -> str:
    return f"with raw_lines as ({view_sql('raw_lines', 'duckdb')}), p as (select *, {_PAYLOAD} as payload from raw_lines), kv as ({_KV}) {body}"


def _field(name: str) -> str:
    return f"max(case when key='{name}' then val end) as {name}"


@query("tag_ingest", with_view("raw_lines", "select event_id, " + ", ".join(f"'{v}' as {k}" for k, v in C.INGEST_TAGS.items()) + " from raw_lines"))
def tag_ingest(spark, sf_dir):
    return P.tag_ingest(view(spark, sf_dir, "raw_lines")).select("event_id", *C.INGEST_TAGS)


@query("dissect_pri", _lines_sql(f"select event_id, case when {_PRI} then regexp_extract(value, '^<([^>]*)>', 1) end as syslog_pri, payload from p"))
def dissect_pri(spark, sf_dir):
    return P.dissect_pri(view(spark, sf_dir, "raw_lines")).select("event_id", "syslog_pri", "payload")


def _names(values: list[str], code: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{code} + 1]"


@query("syslog_priority", _lines_sql(f"""select event_id, pri // 8 as syslog_facility_code, pri % 8 as syslog_severity_code,
 {_names(C.SYSLOG_FACILITIES, '(pri // 8)')} as syslog_facility, {_names(C.SYSLOG_SEVERITIES, '(pri % 8)')} as syslog_severity
 from (select event_id, case when {_PRI} then cast(regexp_extract(value, '^<([^>]*)>', 1) as bigint) end as pri from p) q"""))
def syslog_priority(spark, sf_dir):
    out = P.syslog_priority(P.dissect_pri(view(spark, sf_dir, "raw_lines")))
    return out.select("event_id", "syslog_facility_code", "syslog_severity_code", "syslog_facility", "syslog_severity")


@query("parse_kv", _lines_sql("select event_id, key, val from kv"))
def parse_kv(spark, sf_dir):
    p = P.dissect_pri(view(spark, sf_dir, "raw_lines"))
    return p.select("event_id", F.explode(P.parse_kv(F.col("payload"))).alias("key", "val"))


_LOCAL = "try_cast(concat(date, ' ', time) as timestamp)"


@query("build_timestamp", _lines_sql(f"""select event_id, cast({_LOCAL} - interval 7 hour as varchar) as stamp from (select event_id, {_field('date')}, {_field('time')} from kv group by event_id) f
 union all select event_id, null from p where payload is null"""))
def build_timestamp(spark, sf_dir):
    p = P.dissect_pri(view(spark, sf_dir, "raw_lines"))
    out = P.build_timestamp(p.withColumn("kv", P.parse_kv(F.col("payload"))))
    return out.select("event_id", F.col("`@timestamp`").cast("string").alias("stamp"))


_TYPED = ["srcport", "dstport", "proto", "policyid", "sessionid"]
_TEXT = ["type", "subtype", "devname", "srcip", "dstip", "action", "app", "sentbyte", "rcvdbyte", "msg"]


def parsed(spark, sf_dir):
    return P.parse_firewall(view(spark, sf_dir, "raw_lines"))


@query("normalize_types", _lines_sql("select event_id, " + ", ".join(f"try_cast({c} as bigint) as {c}" for c in _TYPED)
                                     + f" from (select p.event_id, {', '.join(_field(c) for c in _TYPED)} from p left join kv using (event_id) group by p.event_id) f"))
def normalize_types(spark, sf_dir):
    return parsed(spark, sf_dir).select("event_id", *_TYPED)


@query("project_firewall_schema", _lines_sql(f"""select p.event_id, {', '.join(_field(c) for c in _TEXT)}, max(case when key='url' then val end) as extra_url,
 count(case when key='url' then 1 end)::int as extra_keys from p left join kv using (event_id) group by p.event_id"""))
def project_firewall_schema(spark, sf_dir):
    e = parsed(spark, sf_dir)
    return e.select("event_id", *_TEXT, F.col("extra")["url"].alias("extra_url"), F.when(F.col("extra").isNull(), 0).otherwise(F.size("extra")).alias("extra_keys"))


@query("drop_fields", _lines_sql("select event_id, payload is not null as had_payload, true as gone, true as others_stay from p"))
def drop_fields(spark, sf_dir):
    d = P.dissect_pri(view(spark, sf_dir, "raw_lines")).withColumns({"message": F.col("payload"), "fg_timestamp": F.lit("t"), "had_payload": F.col("payload").isNotNull()})
    e = P.drop_fields(d)
    gone, stay = {"payload", "fg_timestamp", "message"} - set(e.columns), set(d.columns) - {"payload", "fg_timestamp", "message", "value"} <= set(e.columns)
    return e.select("event_id", "had_payload", F.lit(len(gone) == 3).alias("gone"), F.lit(stay).alias("others_stay"))


_WIRE = "event_id bigint, srcip string, dstport int, action string, `@timestamp` string"


@query("decode_json", with_view("wire", """select cast(value->>'$.event_id' as bigint) as event_id, value->>'$.srcip' as srcip, cast(value->>'$.dstport' as int) as dstport,
 value->>'$.action' as action, value->>'$."@timestamp"' as stamp from wire where json_valid(value)"""))
def decode_json(spark, sf_dir):
    d = io.decode_json(view(spark, sf_dir, "wire"), _WIRE)
    return d.select("event_id", "srcip", "dstport", "action", F.col("`@timestamp`").alias("stamp"))


# A port as text, a port that is none, a nested value, single quotes, an array and half an object.
_MIXED = """select event_id, case event_id%6 when 0 then concat('{"event_id":', cast(event_id as string), ',"dstport":"', cast(dstport as string), '"}')
 when 1 then concat('{"event_id":', cast(event_id as string), ',"dstport":"n/a","srcip":"', srcip, '"}') when 2 then concat('{"event_id":"', cast(event_id as string), '","dstport":null,"srcip":{"a":1}}')
 when 3 then concat('{''event_id'':', cast(event_id as string), '}') when 4 then '{"event_id":' else concat('{"event_id":', cast(event_id as string), ',"dstport":', cast(dstport as string), '}') end as value from fw_t"""


@query("decode_json_types", with_view("fw_t", f"""select cast(value->>'$.event_id' as bigint) as event_id, try_cast(value->>'$.dstport' as int) as dstport, value->>'$.srcip' as srcip
 from ({_MIXED.replace('as string', 'as varchar')}) m where event_id%6 not in (3, 4)"""))
def decode_json_types(spark, sf_dir):
    m = spark.sql(_MIXED.replace("{", "{{").replace("}", "}}").replace("''event_id''", "\\'event_id\\'").replace("from fw_t", "from {t}"), t=view(spark, sf_dir, "fw_t"))
    return io.decode_json(m, "event_id bigint, dstport int, srcip string")


@query("json_messages", with_view("fw_t", """select concat('{"event_id":', cast(event_id as varchar), ',"srcip":', case when k%3=0 then 'null' else concat('"', srcip, '"') end, '}') as value from fw_t"""))
def json_messages(spark, sf_dir):
    e = view(spark, sf_dir, "fw_t").select("event_id", F.when(F.col("k") % 3 != 0, F.col("srcip")).alias("srcip"))
    return io.to_messages(e)


@query("quarantine_json", with_view("wire", "select value as corrupt from wire where not json_valid(value)"))
def quarantine_json(spark, sf_dir):
    return io.decode_json(view(spark, sf_dir, "wire"), _WIRE, on_error="only").select(F.col("_corrupt").alias("corrupt"))


@query("read_syslog", with_view("raw_lines", "select value from raw_lines"))
def read_syslog(spark, sf_dir):
    path = scratch_path(spark, "syslog")
    view(spark, sf_dir, "raw_lines").select("value").write.text(path)
    return io.read_syslog(spark, path).select("value")


_SYS = r"regexp_matches(value, '^[A-Z][a-z]{2} [ 0-9][0-9] [0-9:]{8} [^ ]+ [a-z]+\[')"
_ACC = r"""regexp_matches(value, '^[^ ]+ [^ ]+ [^ ]+ \[[^\]]+\] "')"""
_ERR = r"regexp_matches(value, '^[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9:]{8} \[')"


@query("read_log_files", with_view("host_lines", rf"""select kind, count(*) as lines, count(distinct a) as sources, count(distinct b) as things from (
 select 'syslog' as kind, regexp_extract(value, ' ([^ \[]+)\[', 1) as a, regexp_extract(value, '\]: (.*)$', 1) as b from host_lines where {_SYS}
 union all select 'access', regexp_extract(value, '^([^ ]+) ', 1), regexp_extract(value, '"GET ([^ ]+) HTTP', 1) from host_lines where {_ACC}
 union all select 'error', regexp_extract(value, '\[([a-z]+)\]', 1), regexp_extract(value, '#0: (.*)$', 1) from host_lines where {_ERR}) u group by 1"""))
def read_log_files(spark, sf_dir):
    path = scratch_path(spark, "hostlogs")
    view(spark, sf_dir, "host_lines").select("value").write.text(path)
    sys = io.read_log_files(spark, path, "syslog").filter("line_kind is not null").select(F.col("line_kind").alias("kind"), F.col("program").alias("a"), F.col("message").alias("b"))
    web = io.read_log_files(spark, path, "apache").filter("line_kind is not null")
    web = web.select(F.col("line_kind").alias("kind"), F.coalesce("client", "severity").alias("a"), F.coalesce("url", "message").alias("b"))
    return sys.unionByName(web).groupBy("kind").agg(F.count("*").alias("lines"), F.countDistinct("a").alias("sources"), F.countDistinct("b").alias("things"))


@query("json_sink", with_view("fw_t", "select event_id, srcip, dstip, t from fw_t"))
def json_sink(spark, sf_dir):
    path = scratch_path(spark, "messages")
    io.json_sink(view(spark, sf_dir, "fw_t").select("event_id", "srcip", "dstip", "t"), path)
    return io.decode_json(spark.read.text(path), "event_id bigint, srcip string, dstip string, t bigint")


@query("model_labels", with_view("fw_scored", """select label, count(*) as n from (select case k%5 when 0 then 'normal' when 1 then 'DoS' when 2 then 'PortScan'
 when 3 then 'Malware' else 'BruteForce' end as label from fw_scored) l group by 1"""))
def model_labels(spark, sf_dir):
    path = scratch_path(spark, "labels")
    meta = json.dumps({"id2label": {str(i): name for i, name in enumerate(C.LABELS)}})
    spark.createDataFrame([(meta,)], "value string").write.text(path)
    labels = io.model_labels(spark, path)
    scored = view(spark, sf_dir, "fw_scored").select((F.col("k") % 5).alias("class_id"))
    return scored.join(F.broadcast(labels), "class_id").groupBy("label").agg(F.count("*").alias("n"))  # one row per class
