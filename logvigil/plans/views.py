"""Derived inputs: the driver tables in the shape of firewall events.

Each view is one SQL text that Spark and DuckDB both run, so an operator and its oracle start from
the same rows. Where the engines name a function differently the text has a slot for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"

VIEWS: dict[str, str] = {}

VIEWS["fw"] = f"""
select event_id, ts,
 concat('10.0.', cast(cast(floor(user_id/256) as bigint) as string), '.', cast(user_id%256 as string)) as srcip,
 case when k<50 then concat('8.8.4.', cast(k as string)) else concat('192.168.1.', cast(k as string)) end as dstip,
 1024 + event_id%60000 as srcport,
 case event_type when 'click' then 443 when 'view' then 80 when 'purchase' then 22
      when 'signup' then 53+1000*(k%3) else 4444 end as dstport,
 case k%3 when 0 then 6 when 1 then 17 else 1 end as proto,
 case event_type when 'error' then 'deny' when 'purchase' then 'close' else 'accept' end as action,
 case event_type when 'purchase' then 'SSH' when 'view' then 'HTTP' else 'HTTPS' end as app,
 cast(floor(value*100) as bigint) as sentbyte, k*37 as rcvdbyte, 1+k%10 as sentpkt, k%7 as rcvdpkt, k as duration
from (select *, {_K} as k from events) e"""

# The real gaps per user are about 11 hours; a hundredth of that suits the 120-600 s operators.
VIEWS["fw_t"] = f"""
select event_id, user_id, event_type, {_K} as k,
 cast(floor((EPOCH(ts)-1704067200)/100) as bigint) as t,
 concat('10.0.0.', cast(user_id%256 as string)) as srcip,
 concat('8.8.4.', cast({_K}%8 as string)) as dstip,
 case event_type when 'click' then 443 when 'view' then 80 when 'purchase' then 22 else 4444 end as dstport,
 case event_type when 'error' then 'deny' else 'accept' end as action,
 case event_type when 'purchase' then 'SSH' when 'view' then 'HTTP' else 'HTTPS' end as app
from events"""

VIEWS["fw_log"] = f"""
select event_id, ts, k, case k%16
 when 0 then 'GET /item?id=1 UNION ALL SELECT name FROM users' when 1 then 'query drop old table'
 when 2 then 'GET /?q=<script>x' when 3 then 'eval(payload)'
 when 4 then 'ping host && id' when 5 then 'GET /../../etc/passwd'
 when 6 then 'login failed bad password repeated 5 times' when 7 then 'account has been locked'
 when 8 then 'Trojan found in upload' when 9 then 'keylogger process'
 when 10 then 'tcp port sweep scan' when 11 then 'path based traversal' when 12 then 'run powershell now'
 when 13 then 'nmap probe' when 14 then concat('action accept user ', cast(user_id as string))
 else concat('traffic forward close bytes ', cast(k as string)) end as full_log,
 cast(100000 + k as string) as rule_id, k%16 as rule_level,
 case event_type when 'error' then 'deny' else 'accept' end as fortinet_action,
 event_type as fortinet_service
from (select *, {_K} as k from events) e"""

VIEWS["fw_scored"] = f"""
select event_id, ts, concat('10.0.0.', cast(user_id%256 as string)) as srcip,
 concat('8.8.4.', cast(k%8 as string)) as dstip, 1024 + event_id%60000 as srcport,
 case event_type when 'click' then 443 when 'view' then 80 when 'purchase' then 22 else 4444 end as dstport,
 case when k%5=0 then 1 else 0 end as dfp_is_anomaly, cast((k%101)/100.0 as double) as dfp_score,
 cast((k%89)/100.0 as double) as dfp_individual_score, cast((k%71)/100.0 as double) as dfp_peer_score,
 case when k%4=0 then null else k%50 end as dfp_peer_group_id,
 case when k%4=0 then 'individual_only' else 'individual_and_peer' end as dfp_detection_method,
 case event_type when 'error' then 'Malware' when 'signup' then 'PortScan' when 'purchase' then 'BruteForce' else 'normal' end as threat_class,
 cast((30 + (event_id*7)%70)/100.0 as double) as confidence,
 case when k%7=0 then 1 else 0 end as llm_is_suspicious, (event_id*13)%101 as llm_confidence,
 case when k%3=0 then concat('reason ', cast(k as string)) else null end as llm_response,
 case when k%5=0 then 'dfp_anomaly' else 'low_bert_conf' end as llm_trigger,
 case when k%6=0 then 'skipped_threshold' when k%6=1 then 'skipped_cooldown' else 'analyzed' end as llm_status,
 case when k%11=0 then null else concat('raw line ', cast(event_id as string)) end as event_original,
 case event_type when 'purchase' then 'SSH' when 'view' then 'HTTP' else 'HTTPS' end as app,
 case event_type when 'error' then 'deny' else 'accept' end as action,
 case k%3 when 0 then 6 when 1 then 17 else 1 end as proto,
 cast(floor(value*100) as bigint) as sentbyte, k*37 as rcvdbyte, k as duration, k as k
from (select *, {_K} as k from events) e"""

# Raw syslog: a quoted space, a value holding "=", a repeated pair, bad ports and lines without <PRI>.
VIEWS["raw_lines"] = f"""
select event_id, concat(case when k%23=0 then '' else concat('<', cast(event_id%192 as string), '>') end,
 'date=', substring(cast(ts as string), 1, 10), ' time=', substring(cast(ts as string), 12, 8),
 ' devname="FG ', cast(k%3 as string), '" type=traffic subtype=forward srcip=10.0.0.', cast(user_id%256 as string),
 ' srcport=', case when k%17=0 then 'n/a' else cast(1024 + event_id%60000 as string) end,
 ' dstip=', case when k<50 then '8.8.4.' else '192.168.1.' end, cast(k as string),
 ' dstport=', cast(case event_type when 'click' then 443 when 'view' then 80 else 22 end as string),
 ' proto=6 action="accept" app="', case event_type when 'purchase' then 'SSH' else 'HTTPS' end,
 '" policyid=', cast(k%9 as string), ' sessionid=', cast(event_id as string),
 ' sentbyte=', cast(k*11 as string), ' rcvdbyte=', case when k%13=0 then '-' else cast(k*37 as string) end,
 ' url="http://h/?a=', cast(k as string), '&b=1" action="accept" msg="user said: x=y"') as value
from (select *, {_K} as k from events) e"""

# Wire messages, some cut short.
VIEWS["wire"] = f"""
select event_id, case when k%10=9 then concat('{{"event_id": ', cast(event_id as string), ', "srcip": "10.0')
 else concat('{{"event_id": ', cast(event_id as string), ', "srcip": "10.0.0.', cast(user_id%256 as string),
 '", "dstport": ', cast(k as string), ', "action": "', event_type, '"',
 case when k%4=0 then '' else concat(', "@timestamp": "', replace(substring(cast(ts as string), 1, 19), ' ', 'T'), 'Z"') end,
 '}}') end as value
from (select *, {_K} as k from events) e"""

# Model answers in the forms the verdict parsers must tell apart.
VIEWS["answers"] = f"""
select event_id, case when k%5=0 then 1 else 0 end as dfp_is_anomaly, case k%10
 when 0 then concat('{{"is_threat": true, "confidence": ', cast(k as string), ', "reason": "scan ', cast(event_id as string), '"}}')
 when 1 then concat('Sure. {{"is_threat": false, "confidence": ', cast(k as string), ', "reason": "ok"}} done')
 when 2 then '{{"is_threat": true, "reason": "x"}}'
 when 3 then concat('This looks malicious ', cast(k as string))
 when 4 then concat('All fine here ', cast(k as string))
 when 5 then '{{"is_threat": true, "confidence": }}'
 when 6 then '{{"is_threat": no, "confidence": 5}}'
 when 7 then concat('{{"is_threat": true, "confidence": "', cast(k as string), '%"}}')
 when 8 then concat('{{"is_threat": true, "confidence": "', cast(k as string), '", "reason": "quoted"}}')
 else concat('Answer:\n{{"is_threat": true,\n"confidence": ', cast(k as string), '}}') end as answer
from (select *, {_K} as k from events) e"""

# Host logs in the two declared formats.
VIEWS["host_lines"] = """
select event_id, case event_id%3
 when 0 then concat('Jan ', case when day(ts)<10 then ' ' else '' end, cast(day(ts) as string), ' ', substring(cast(ts as string), 12, 8),
   ' web01 sshd[', cast(1000+user_id as string), ']: Failed password for user', cast(user_id as string), ' from 10.0.0.', cast(user_id%256 as string))
 when 1 then concat('10.0.0.', cast(user_id%256 as string), ' - - [', case when day(ts)<10 then '0' else '' end, cast(day(ts) as string), '/Jan/2024:',
   substring(cast(ts as string), 12, 8), ' +0000] "GET /', event_type, '?u=', cast(user_id as string), ' HTTP/1.1" 200 ', cast(event_id as string), ' "-" "agent/1.0"')
 else concat(replace(substring(cast(ts as string), 1, 10), '-', '/'), ' ', substring(cast(ts as string), 12, 8),
   ' [error] ', cast(user_id as string), '#0: *', cast(event_id as string), ' open() failed') end as value
from events"""

# Addresses of many classes from event numbers, malformed ones included.
VIEWS["addresses"] = """
select event_id, case event_id%8
 when 0 then concat(cast((event_id*7)%256 as string), '.', cast((event_id*13)%256 as string), '.', cast(event_id%3 as string), '.', cast(event_id%11 as string))
 when 1 then concat('172.', cast(10+(event_id*5)%28 as string), '.', cast(event_id%256 as string), '.1')
 when 2 then concat('192.', cast((event_id*3)%256 as string), '.', cast(event_id%4 as string), '.', cast((event_id*11)%14 as string))
 when 3 then concat('198.', cast(15+event_id%40 as string), '.', cast(event_id%256 as string), '.9')
 when 4 then concat(cast(90+event_id%200 as string), '.64.0.1')
 when 5 then concat('10.0.0.', cast(event_id%300 as string))
 when 6 then concat('0', cast(event_id%20 as string), '.0.0.1')
 else case when event_id%5=0 then '' when event_id%5=1 then 'host' else concat('203.0.113.', cast(event_id%256 as string)) end end as ip
from events"""

# Enrichment records that look back at the scored events: every event asks, up to 4 minutes late.
VIEWS["asks"] = f"""
select event_id as ask_id, ts, t + (event_id*37)%240 as t, t as event_t,
 srcip, dstip, case when k%3=0 then srcport end as srcport, case when k%5=0 then dstport end as dstport,
 llm_is_suspicious, llm_confidence, llm_response, llm_trigger
from (select *, cast(floor((EPOCH(ts)-1704067200)/100) as bigint) as t from ({VIEWS["fw_scored"]}) f) f"""

VIEWS["base_docs"] = f"""
select event_id as doc_id, cast(floor((EPOCH(ts)-1704067200)/100) as bigint) as t, srcip, dstip, srcport, dstport
from ({VIEWS["fw_scored"]}) f"""

_EPOCH = {"spark": "unix_timestamp(cast(ts as timestamp))", "duckdb": "floor(epoch(ts))"}


def view_sql(name: str, engine: str) -> str:
    return VIEWS[name].replace("EPOCH(ts)", _EPOCH[engine])


def utc(spark: SparkSession) -> SparkSession:
    """The session with its zone set to UTC, the zone of the tables' clocks."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derived view over the tables of ``sf_dir``."""
    sql = _escape(view_sql(name, "spark")).replace("from events", "from {events}")
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


def _escape(sql: str) -> str:
    """Braces in the view text are literal."""
    return sql.replace("{", "{{").replace("}", "}}")
