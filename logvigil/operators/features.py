"""Per-event features. Every function adds columns and stays inside code generation.

A field counts as present when it is non-null in its own row, so results never depend on which
other rows share a batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.fields import event_time, has, ipv4_number, is_private_v4, private_v6_sql, safe_float, text_col


def entity_key(df: DataFrame, field: str = "srcip", fallback: str = "fortinet_srcip") -> Column:
    """The entity of an event: ``field``, else ``fallback``, empty text counting as missing."""
    cols = [F.nullif(text_col(df, n), F.lit("")) for n in (field, fallback) if has(df, n)]
    return F.coalesce(*cols) if cols else F.lit(None).cast("string")


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def is_traffic(df: DataFrame) -> Column:
    """Traffic event, judged by its byte/duration fields, its type or its subtype."""
    present = reduce(
        lambda a, b: a | b,
        [F.col(n).isNotNull() for n in ("sentbyte", "rcvdbyte", "duration") if has(df, n)],
        F.lit(False),
    )
    return (
        present
        | (F.lower(text_col(df, "type", "")) == "traffic")
        | (F.lower(text_col(df, "subtype", "")) == "forward")
    )


def log_kind(df: DataFrame) -> DataFrame:
    return df.withColumn("log_kind", F.when(is_traffic(df), "traffic").otherwise("utm"))


def temporal_features(df: DataFrame, zone: str = "UTC", hour_mode: str = "offset", clock: Column | None = None) -> DataFrame:
    """hour, day_of_week (Monday 0) and the weekend / business-hours / night flags; zeros without a time."""
    t = event_time(df, zone=zone, hour_mode=hour_mode) if clock is None else clock
    timed = df.withColumn("_clock", t)
    known = F.col("_clock").isNotNull()
    hour = F.when(known, F.hour("_clock")).otherwise(0)
    dow = F.when(known, F.weekday("_clock")).otherwise(0)
    return (
        timed.withColumns({"hour": hour, "day_of_week": dow})
        .withColumns({
            "is_weekend": _flag(known & (F.col("day_of_week") >= 5)),
            "is_business_hours": _flag(known & F.col("hour").between(9, 17)),
            "is_night": _flag(known & ((F.col("hour") >= 22) | (F.col("hour") <= 6))),
        })
        .drop("_clock")
    )


def port_features(df: DataFrame) -> DataFrame:
    return df.withColumns({n: safe_float(df, n) for n in ("srcport", "dstport")})


_TRAFFIC_FIELDS = ("sentbyte", "rcvdbyte", "sentpkt", "rcvdpkt", "duration", "sentdelta", "rcvddelta")


def traffic_metrics(df: DataFrame) -> DataFrame:
    """The seven traffic measures as doubles, 0.0 for events that carry no traffic."""
    traffic = is_traffic(df)
    return df.withColumns({n: F.when(traffic, safe_float(df, n)).otherwise(0.0) for n in _TRAFFIC_FIELDS})


def traffic_totals(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "total_bytes": F.col("sentbyte") + F.col("rcvdbyte"),
        "total_packets": F.col("sentpkt") + F.col("rcvdpkt"),
    })


def _ratio(num: str, den: str) -> Column:
    return F.when(F.col(den) > 0, F.col(num) / F.col(den)).otherwise(0.0)


def traffic_ratios(df: DataFrame) -> DataFrame:
    """Bytes per packet and sent shares; needs ``traffic_totals``."""
    any_bytes = (F.col("sentbyte") != 0) | (F.col("rcvdbyte") != 0)
    # rcvdbyte = -1 has no defined ratio; the guard keeps the plan running on such input
    shifted = F.col("rcvdbyte") + 1.0
    return df.withColumns({
        "bytes_per_packet_sent": _ratio("sentbyte", "sentpkt"),
        "bytes_per_packet_rcvd": _ratio("rcvdbyte", "rcvdpkt"),
        "bytes_sent_ratio": _ratio("sentbyte", "total_bytes"),
        "packets_sent_ratio": _ratio("sentpkt", "total_packets"),
        "bytes_ratio": F.when(any_bytes & (shifted != 0), F.col("sentbyte") / shifted).otherwise(0.0),
    })


def protocol_flags(df: DataFrame) -> DataFrame:
    proto = F.lower(text_col(df, "proto", ""))
    return df.withColumns({
        f"is_{name}": F.when(proto.isin(alias), 1.0).otherwise(0.0) for name, alias in C.PROTOCOL_ALIASES.items()
    })


def app_features(df: DataFrame) -> DataFrame:
    """appid and one-hot risk, for UTM events and events that carry an appid."""
    applies = ~is_traffic(df) | (F.col("appid").isNotNull() if has(df, "appid") else F.lit(False))
    risk = F.lower(text_col(df, "apprisk", ""))
    cols = {f"apprisk_{r}": _flag(applies & (risk == r)) for r in C.APP_RISKS}
    return df.withColumns({"appid": F.when(applies, safe_float(df, "appid")).otherwise(0.0), **cols})


def action_flags(df: DataFrame) -> DataFrame:
    action = F.lower(text_col(df, "action", ""))
    return df.withColumns({
        "action_deny": _flag(action.isin(C.DENY_ACTIONS)),
        "action_accept": _flag(action.isin(C.ACCEPT_ACTIONS)),
    })


def ip_direction(df: DataFrame) -> DataFrame:
    """Internal flags of both ends; external when exactly one end is internal."""
    # IPv4 runs in generated code on number columns; IPv6 is one shared expression for both ends
    ends = df.withColumns({"_srcip": text_col(df, "srcip"), "_dstip": text_col(df, "dstip")})
    numbers = ends.withColumns({
        "_src": ipv4_number("_srcip"), "_dst": ipv4_number("_dstip"),
        "_six": F.expr(f"transform(array(_srcip, _dstip), ip -> {private_v6_sql('ip')})"),
    })
    inside = lambda i, n: _flag(F.coalesce(F.get("_six", F.lit(i)), is_private_v4(n)))
    return (
        numbers.withColumns({"is_internal_src": inside(0, "_src"), "is_internal_dst": inside(1, "_dst")})
        .withColumn("is_external", _flag(F.col("is_internal_src") != F.col("is_internal_dst")))
        .drop("_srcip", "_dstip", "_src", "_dst", "_six")
    )


def port_class(df: DataFrame) -> DataFrame:
    """Common / high / suspicious destination port; needs numeric dstport."""
    p = F.col("dstport")
    port = F.when(p.isNull() | F.isnan(p) | (F.abs(p) > 1e15), 0).otherwise(
        F.when(p >= 0, F.floor(p)).otherwise(F.ceil(p))
    )
    return df.withColumn("_port", port).withColumns({
        "is_common_port": _flag(F.col("_port").isin(C.COMMON_PORTS)),
        "is_high_port": _flag(F.col("_port") > 1024),
        "is_suspicious_port": _flag(F.col("_port").isin(C.SUSPICIOUS_PORTS)),
    }).drop("_port")


def event_features(df: DataFrame, zone: str = "UTC", hour_mode: str = "offset", clock: Column | None = None) -> DataFrame:
    """All per-event features. Raw columns of the same name are replaced by their numeric form."""
    out = temporal_features(df, zone, hour_mode, clock)
    out = app_features(out)  # reads the raw traffic fields, so it runs before they are filled
    out = traffic_metrics(out)
    out = port_features(out)
    for step in (traffic_totals, traffic_ratios, protocol_flags, action_flags, ip_direction, port_class):
        out = step(out)
    return out


def vector_names(which: str = "traffic") -> list[str]:
    return {"traffic": C.TRAFFIC_FEATURES, "utm": C.UTM_FEATURES}[which]


def feature_vector(df: DataFrame, which: str = "traffic") -> Column:
    """Feature array in declared order, missing and non-finite values 0.0.

    ``which="auto"`` picks the UTM set for UTM events (needs ``log_kind``).
    """
    if which == "auto":
        return F.when(F.col("log_kind") == "traffic", feature_vector(df, "traffic")).otherwise(feature_vector(df, "utm"))
    return F.array(*[sanitize(df, n) for n in vector_names(which)])


def sanitize_sql(name: str) -> str:
    return f"coalesce(if(isnan(`{name}`) or abs(`{name}`) = double('inf'), 0.0D, cast(`{name}` as double)), 0.0D)"


def sanitize(df: DataFrame, name: str) -> Column:
    """The column as a finite double, 0.0 where absent, null, NaN or infinite."""
    return F.expr(sanitize_sql(name)) if has(df, name) else F.lit(0.0)
