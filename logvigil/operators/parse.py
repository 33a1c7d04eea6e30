"""Raw firewall syslog to typed events, as column expressions over text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.fields import let


def tag_ingest(df: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    """Constant columns that say how the line came in."""
    return df.withColumns({k: F.lit(v) for k, v in (tags or C.INGEST_TAGS).items()})


_PRI = r"(?s)^<([^>]*)>(.*)$"


def dissect_pri(df: DataFrame, col: str = "value") -> DataFrame:
    """Split ``<PRI>payload``; lines of another form get nulls."""
    hit = F.col(col).rlike(_PRI)
    return df.withColumns({
        "syslog_pri": F.when(hit, F.regexp_extract(col, _PRI, 1)),
        "payload": F.when(hit, F.regexp_extract(col, _PRI, 2)),
    })


def syslog_priority(df: DataFrame) -> DataFrame:
    """Facility and severity codes and labels from ``syslog_pri``."""
    pri = F.expr("try_cast(syslog_pri as bigint)")
    names = lambda values, code: F.get(F.array(*[F.lit(v) for v in values]), code.cast("int"))
    out = df.withColumn("_pri", pri).withColumns({
        "syslog_facility_code": F.expr("_pri div 8"),
        "syslog_severity_code": F.expr("_pri % 8"),
    })
    return out.withColumns({
        "syslog_facility": names(C.SYSLOG_FACILITIES, F.col("syslog_facility_code")),
        "syslog_severity": names(C.SYSLOG_SEVERITIES, F.col("syslog_severity_code")),
    }).drop("_pri")


_PAIR = r'[^ =]+=(?:"[^"]*"|[^ ]*)'


def parse_kv(payload: Column) -> Column:
    """``key=value`` pairs to a map: quoted values may hold spaces, quotes are stripped, repeated
    identical pairs collapse. A key repeated with different values keeps its last one."""
    # one pass of the pattern; a key holds no "=", so the first one splits the pair
    pairs = F.array_distinct(F.regexp_extract_all(payload, F.lit(_PAIR), F.lit(0)))
    keys = lambda p: F.transform(p, lambda x: F.translate(F.substring_index(x, "=", 1), '"', ""))
    values = lambda p: F.transform(p, lambda x: F.trim(F.substring(x, F.instr(x, "=") + 1, F.length(x)), F.lit('"')))

    def last_wins(k: Column, v: Column) -> Column:
        # walking backwards, a pair whose key is already held is an older value
        entries = F.reverse(F.zip_with(k, v, lambda a, b: F.struct(a.alias("key"), b.alias("value"))))
        kept = F.aggregate(
            entries,
            F.array().cast("array<struct<key:string,value:string>>"),
            lambda acc, e: F.when(F.exists(acc, lambda a: a["key"] == e["key"]), acc).otherwise(F.array_append(acc, e)),
        )
        return F.map_from_entries(F.reverse(kept))

    def to_map(p: Column) -> Column:
        unique = lambda k: F.size(F.array_distinct(k)) == F.size(k)
        return let(keys(p), lambda k: F.when(unique(k), F.map_from_arrays(k, values(p))).otherwise(last_wins(k, values(p))))

    return F.when(payload.isNotNull(), let(pairs, to_map))


def build_timestamp(df: DataFrame, kv: str = "kv", zone: str = C.INGEST_ZONE) -> DataFrame:
    """``@timestamp`` (an instant) from the device's local ``date`` and ``time``."""
    local = F.concat_ws(" ", F.col(kv)["date"], F.col(kv)["time"])
    at = F.try_to_timestamp(local, F.lit("yyyy-MM-dd HH:mm:ss"))
    both = F.col(kv)["date"].isNotNull() & F.col(kv)["time"].isNotNull()
    return df.withColumn("@timestamp", F.when(both, F.to_utc_timestamp(at, zone)))


def normalize_types(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """The integer fields as BIGINT; text that is no integer becomes null."""
    return df.withColumns({f: F.col(f).try_cast("bigint") for f in fields or C.INTEGER_FIELDS if f in df.columns})


def drop_fields(df: DataFrame, fields: tuple[str, ...] = ("payload", "fg_timestamp", "message", "value")) -> DataFrame:
    return df.drop(*fields)


FIREWALL_FIELDS = [
    "type", "subtype", "devname", "vd", "srcip", "srcport", "srcname", "srcintf", "dstip", "dstport", "dstname",
    "dstintf", "proto", "action", "service", "app", "appcat", "appid", "apprisk", "policyid", "policyname",
    "sessionid", "eventtime", "sentbyte", "rcvdbyte", "sentpkt", "rcvdpkt", "duration", "sentdelta", "rcvddelta", "msg",
]


def project_firewall_schema(df: DataFrame, kv: str = "kv", fields: list[str] | None = None) -> DataFrame:
    """Known keys of the map as columns; what remains goes to ``extra``."""
    names = fields or FIREWALL_FIELDS
    used = [*names, "date", "time"]
    out = df.withColumns({n: F.col(kv)[n] for n in names})
    return out.withColumn("extra", F.map_filter(kv, lambda k, v: ~k.isin(used))).drop(kv)


def parse_firewall(df: DataFrame, col: str = "value", zone: str = C.INGEST_ZONE) -> DataFrame:
    """The whole chain: line to typed event. Batch and stream; no shuffle."""
    out = syslog_priority(dissect_pri(tag_ingest(df), col)).withColumn("event_original", F.col(col))
    out = build_timestamp(out.withColumn("kv", parse_kv(F.col("payload"))), zone=zone)
    return drop_fields(normalize_types(project_firewall_schema(out)))
