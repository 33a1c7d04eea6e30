"""Feature queries over the firewall view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import constants as C
from ...functions import fields as FI
from ...operators import features as FE
from .registry import query, view, with_view

OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"


def v4_sql(ip: str) -> str:
    parts = "+".join(f"cast(split_part({ip},'.',{i}) as bigint)*{256 ** (4 - i)}" for i in (1, 2, 3, 4))
    return rf"case when regexp_full_match({ip}, '{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}') then {parts} end"


def private_sql(n: str) -> str:
    """Private IPv4 by number, in SQL."""
    import ipaddress

    def within(nets: list[str]) -> str:
        spans = [ipaddress.ip_network(x) for x in nets]
        return " or ".join(f"{n} between {int(s.network_address)} and {int(s.broadcast_address)}" for s in spans)

    return f"(coalesce(({within(C.PRIVATE_V4)}) and not ({within(C.PRIVATE_V4_EXCEPT)}), false))"


def _in(values: list) -> str:
    return "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + ")"


def feature_sql(source: str = "fw") -> str:
    """All per-event features of the firewall view as nested selects."""
    return f"""select *, case when is_internal_src <> is_internal_dst then 1 else 0 end as is_external,
 case when bytes_x then sentbyte/(rcvdbyte+1.0) else 0.0 end as bytes_ratio,
 case when total_bytes>0 then sentbyte/total_bytes else 0.0 end as bytes_sent_ratio,
 case when total_packets>0 then sentpkt/total_packets else 0.0 end as packets_sent_ratio
from (select event_id, ts, srcip as entity, srcport::double as srcport, dstport::double as dstport,
 sentbyte::double as sentbyte, rcvdbyte::double as rcvdbyte, sentpkt::double as sentpkt, rcvdpkt::double as rcvdpkt,
 duration::double as duration, 0.0::double as sentdelta, 0.0::double as rcvddelta,
 case when proto=6 then 1.0 else 0.0 end::double as is_tcp, case when proto=17 then 1.0 else 0.0 end::double as is_udp,
 case when proto=1 then 1.0 else 0.0 end::double as is_icmp,
 hour(ts)::int as hour, (isodow(ts)-1)::int as day_of_week,
 case when isodow(ts)>=6 then 1 else 0 end as is_weekend,
 case when hour(ts) between 9 and 17 then 1 else 0 end as is_business_hours,
 case when hour(ts)>=22 or hour(ts)<=6 then 1 else 0 end as is_night,
 case when sentpkt>0 then sentbyte::double/sentpkt else 0.0 end as bytes_per_packet_sent,
 case when rcvdpkt>0 then rcvdbyte::double/rcvdpkt else 0.0 end as bytes_per_packet_rcvd,
 (sentbyte+rcvdbyte)::double as total_bytes, (sentpkt+rcvdpkt)::double as total_packets,
 (sentbyte<>0 or rcvdbyte<>0) as bytes_x,
 case when {private_sql(v4_sql('srcip'))} then 1 else 0 end as is_internal_src,
 case when {private_sql(v4_sql('dstip'))} then 1 else 0 end as is_internal_dst,
 case when dstport>1024 then 1 else 0 end as is_high_port,
 case when dstport in {_in(C.COMMON_PORTS)} then 1 else 0 end as is_common_port,
 case when dstport in {_in(C.SUSPICIOUS_PORTS)} then 1 else 0 end as is_suspicious_port,
 case when lower(action) in {_in(C.DENY_ACTIONS)} then 1 else 0 end as action_deny,
 case when lower(action) in {_in(C.ACCEPT_ACTIONS)} then 1 else 0 end as action_accept,
 {", ".join(f"0 as apprisk_{r}" for r in C.APP_RISKS)}, 0.0::double as appid
 from {source}) f0"""


def _feature_query(name: str, columns: list[str], step, source: str = "fw") -> None:
    shown = ["event_id", *columns]

    @query(name, with_view("fw", f"select {', '.join(shown)} from ({feature_sql()}) f"))
    def run(spark, sf_dir):
        return step(view(spark, sf_dir, source)).select(*shown)


_feature_query("temporal_features", ["hour", "day_of_week", "is_weekend", "is_business_hours", "is_night"],
               lambda e: FE.temporal_features(e, clock=F.col("ts")))
_feature_query("port_features", ["srcport", "dstport"], FE.port_features)
_feature_query("traffic_metrics", list(FE._TRAFFIC_FIELDS), FE.traffic_metrics)
_feature_query("traffic_totals", ["total_bytes", "total_packets"], lambda e: FE.traffic_totals(FE.traffic_metrics(e)))
_feature_query("protocol_flags", ["is_tcp", "is_udp", "is_icmp"], FE.protocol_flags)
_feature_query("action_flags", ["action_deny", "action_accept"], FE.action_flags)
_feature_query("ip_direction", ["is_internal_src", "is_internal_dst", "is_external"], FE.ip_direction)
_feature_query("port_class", ["is_common_port", "is_high_port", "is_suspicious_port"], lambda e: FE.port_class(FE.port_features(e)))

_RATIOS = ["bytes_per_packet_sent", "bytes_per_packet_rcvd", "bytes_sent_ratio", "packets_sent_ratio", "bytes_ratio"]


@query("traffic_ratios", with_view("fw", f"select event_id, {', '.join(f'round({c}, 6) as {c}' for c in _RATIOS)} from ({feature_sql()}) f"))
def traffic_ratios(spark, sf_dir):
    e = FE.traffic_ratios(FE.traffic_totals(FE.traffic_metrics(view(spark, sf_dir, "fw"))))
    return e.select("event_id", *[F.round(c, 6).alias(c) for c in _RATIOS])


# A view whose rows are partly UTM events with an application risk.
_UTM = """select event_id, case when k%3=0 then cast(k as string) end as sentbyte, case when k%7=0 then cast(k as string) end as duration,
 case when k%5=0 then 'Traffic' when k%5=1 then 'utm' end as type, case when k%11=0 then 'forward' end as subtype,
 case when k%2=0 then k*100 end as appid,
 case k%6 when 0 then 'low' when 1 then 'Medium' when 2 then 'high' when 3 then 'CRITICAL' when 4 then 'elevated' end as apprisk
 from fw_scored"""
_KIND = "(sentbyte is not null or duration is not null or lower(type)='traffic' or lower(subtype)='forward')"


def _utm(spark, sf_dir):
    return spark.sql(_UTM.replace("fw_scored", "{fw_scored}"), fw_scored=view(spark, sf_dir, "fw_scored"))


@query("log_kind", with_view("fw_scored", f"select event_id, case when coalesce({_KIND}, false) then 'traffic' else 'utm' end as log_kind from ({_UTM}) u"))
def log_kind(spark, sf_dir):
    return FE.log_kind(_utm(spark, sf_dir)).select("event_id", "log_kind")


_APPLIES = f"(not coalesce({_KIND}, false) or appid is not null)"


@query("app_features", with_view("fw_scored", f"""select event_id, case when {_APPLIES} then coalesce(appid, 0) else 0 end::double as appid,
 {", ".join(f"case when {_APPLIES} and lower(apprisk)='{r}' then 1 else 0 end as apprisk_{r}" for r in C.APP_RISKS)} from ({_UTM}) u"""))
def app_features(spark, sf_dir):
    return FE.app_features(_utm(spark, sf_dir)).select("event_id", "appid", *[f"apprisk_{r}" for r in C.APP_RISKS])


@query("is_private_ip", with_view("addresses", f"select event_id, ip, case when {private_sql(v4_sql('ip'))} then 1 else 0 end as is_private from addresses"))
def is_private_ip(spark, sf_dir):
    e = view(spark, sf_dir, "addresses")
    return e.select("event_id", "ip", FI.is_private_ip("ip").cast("int").alias("is_private"))


_VALUES = """select event_id, case k%8 when 0 then cast(k as string) when 1 then concat(cast(k as string), '.25') when 2 then 'n/a'
 when 3 then '' when 4 then concat(' ', cast(k as string), ' ') when 5 then concat('-', cast(k as string), 'e1') when 6 then null
 else concat('1_', cast(100+k as string)) end as raw from fw_scored"""


@query("safe_float", with_view("fw_scored", f"""select event_id, coalesce(case when regexp_full_match(trim(raw), '[0-9]+(_[0-9]+)*')
 then try_cast(replace(raw, '_', '') as double) else try_cast(raw as double) end, 0.0) as val from ({_VALUES}) v"""))
def safe_float(spark, sf_dir):
    e = spark.sql(_VALUES.replace("fw_scored", "{fw_scored}"), fw_scored=view(spark, sf_dir, "fw_scored"))
    return e.select("event_id", FI.safe_float(e, "raw").alias("val"))


_EPOCH_US = {"spark": "unix_micros(cast(ts as timestamp))", "duckdb": "epoch_us(ts)"}


def _stamps(engine: str, source: str) -> str:
    us = _EPOCH_US[engine]
    div = "div" if engine == "spark" else "//"
    return f"""select event_id,
 case when event_id%4=0 then concat(replace(substring(cast(ts as string), 1, 19), ' ', 'T'), case when event_id%8=0 then 'Z' else '+07:00' end)
      when event_id%4=1 then '' when event_id%20=2 then 'yesterday' end as `@timestamp`,
 case when event_id%4 in (1, 2) and event_id%20<>2 then concat(substring(cast(ts as string), 1, 10), ' ', substring(cast(ts as string), 12, 8)) end as timestamp,
 case when event_id%12=3 then {us}*1000 when event_id%12=7 then {us} {div} 1000 when event_id%12=11 then {us} {div} 1000000 end as eventtime
 from {source}"""


@query("event_time", f"""select event_id, coalesce(hour(w), 0)::int as hour, coalesce(isodow(w)-1, 0)::int as day_of_week,
 cast(w as varchar) is not null as timed from (select event_id, case
 when coalesce(a, '') <> '' then try_cast(regexp_replace(a, '(Z|[+-][0-9][0-9]:[0-9][0-9])$', '') as timestamp)
 when timestamp is not null then try_cast(timestamp as timestamp)
 when eventtime > 1e15 then make_timestamp(eventtime//1000) when eventtime > 1e10 then make_timestamp(eventtime*1000)
 else make_timestamp(eventtime*1000000) end as w
 from (select event_id, "@timestamp" as a, timestamp, eventtime from ({_stamps('duckdb', 'events').replace('`', '"')}) s0) s) t""")
def event_time(spark, sf_dir):
    from ..views import table

    e = spark.sql(_stamps("spark", "{events}"), events=table(spark, sf_dir, "events"))
    e = e.withColumn("w", FI.event_time(e))
    return e.select(
        "event_id", F.coalesce(F.hour("w"), F.lit(0)).alias("hour"), F.coalesce(F.weekday("w"), F.lit(0)).alias("day_of_week"),
        F.col("w").isNotNull().alias("timed"),
    )


def _vector_sql(names: list[str], missing: tuple[str, ...] = ("port_entropy", "byte_variance")) -> str:
    cells = ", ".join("0.0" if n in missing else f"{n}::double" for n in names)
    return f"[{cells}]"


@query("feature_vector", with_view("fw", f"""select event_id, len(v) as dims, round(list_sum(v), 4) as total, round(v[1], 4) as first,
 len(u) as utm_dims, round(list_sum(u), 4) as utm_total
 from (select event_id, {_vector_sql(C.TRAFFIC_FEATURES)} as v, {_vector_sql(C.UTM_FEATURES)} as u from ({feature_sql()}) f) g"""))
def feature_vector(spark, sf_dir):
    e = FE.event_features(view(spark, sf_dir, "fw"), clock=F.col("ts"))
    v = e.select("event_id", FE.feature_vector(e, "traffic").alias("v"), FE.feature_vector(e, "utm").alias("u"))
    add = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 4)
    return v.select("event_id", F.size("v").alias("dims"), add("v").alias("total"), F.round(F.get("v", F.lit(0)), 4).alias("first"),
                    F.size("u").alias("utm_dims"), add("u").alias("utm_total"))


@query("sanitize_numeric", with_view("fw_scored", """select event_id, case when k%5 in (0,1,2) then 0.0 when k%5=3 then k::double else -k::double end as val from fw_scored"""))
def sanitize_numeric(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored")
    raw = (F.when(F.col("k") % 5 == 0, float("nan")).when(F.col("k") % 5 == 1, float("inf")).when(F.col("k") % 5 == 2, float("-inf"))
           .when(F.col("k") % 5 == 3, F.col("k").cast("double")).otherwise(-F.col("k").cast("double")))
    return e.select("event_id", raw.alias("raw")).select("event_id", FI.finite(F.col("raw")).alias("val"))


_KEYS = "select event_id, case when k%3=0 then srcip when k%3=1 then '' end as srcip, case when k%4<3 then dstip when k%8=3 then '' end as fortinet_srcip from fw_scored"


@query("entity_key", with_view("fw_scored", f"select event_id, coalesce(nullif(srcip,''), nullif(fortinet_srcip,'')) as entity from ({_KEYS}) k"))
def entity_key(spark, sf_dir):
    e = spark.sql(_KEYS.replace("fw_scored", "{fw_scored}"), fw_scored=view(spark, sf_dir, "fw_scored"))
    return e.select("event_id", FE.entity_key(e).alias("entity"))


# The whole feature block over the large line-item table, reduced to one row per destination service.
_BULK = """select l_orderkey*8+l_linenumber as event_id, l_shipdate as ts, concat('10.', cast(l_partkey%200 as string), '.0.1') as srcip,
 concat(cast(1+l_suppkey%220 as string), '.9.9.9') as dstip, l_linenumber as srcport, l_suppkey as dstport, 6 as proto,
 case when l_returnflag='R' then 'deny' else 'accept' end as action,
 l_extendedprice as sentbyte, l_tax*1000 as rcvdbyte, l_quantity as sentpkt, l_linenumber as rcvdpkt, l_discount as duration from lineitem"""


@query("feature_block_bulk", f"""select is_high_port, is_external, hour, action_deny, count(*) as n, round(sum(total_bytes), 2) as total_bytes,
 round(avg(bytes_ratio), 6) as avg_bytes_ratio, round(avg(bytes_per_packet_sent), 6) as avg_bpp, sum(is_weekend)::bigint as weekend
 from ({feature_sql(f'({_BULK}) b')}) f group by all""")
def feature_block_bulk(spark, sf_dir):
    from ..views import table

    e = spark.sql(_BULK.replace("from lineitem", "from {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))
    f = FE.event_features(e, clock=F.col("ts"))
    return f.groupBy("is_high_port", "is_external", "hour", "action_deny").agg(
        F.count("*").alias("n"), F.round(F.sum("total_bytes"), 2).alias("total_bytes"),
        F.round(F.avg("bytes_ratio"), 6).alias("avg_bytes_ratio"), F.round(F.avg("bytes_per_packet_sent"), 6).alias("avg_bpp"),
        F.sum("is_weekend").alias("weekend"),
    )
