"""Alert rules: a rule table compiled to columns, frequency rules, routing and responses."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import range_counts, range_sums


@dataclass(frozen=True)
class Rule:
    """One rule. ``fields`` maps a field to a value (equality), a ``(low, high)`` band
    (low <= x < high) or True (present and not empty). ``parents``: any of them must have fired."""

    rule_id: int
    level: int
    description: str
    parents: tuple[int, ...] = ()
    decoded_as: str | None = None
    match: str | None = None
    fields: dict = field(default_factory=dict)
    frequency: int | None = None
    timeframe: int | None = None
    same_source_ip: bool = False
    groups: tuple[str, ...] = ()


_INF = float("inf")
_BANDS = (100101, 100102, 100103)
LOW, MEDIUM, HIGH = 0.60, 0.75, 0.95
_AI, _TRAFFIC, _REVIEW = ("ai", "ai_threat_detection"), ("fortigate", "syslog"), ("ai", "llm_threats")


def _threat(rule_id: int, level: int, kind: str, title: str, groups: tuple[str, ...] | None = None) -> Rule:
    return Rule(rule_id, level, f"AI: {title} detected from $(srcip)", _BANDS, fields={"threat_type": kind}, groups=_AI + (groups or ("ai_threat", kind, "attack")))


# --- fixed values: rule ids, levels, bands, timeframes, and the groups, those around a rule first ---
RULES: tuple[Rule, ...] = (
    Rule(300002, 0, "Suppress listening-port alerts", (533,), groups=("drop_net_stat",)),
    Rule(100100, 0, "AI threat detection", decoded_as="threat-ai", groups=_AI),
    Rule(100101, 5, "AI: Low confidence threat detected ($(threat_type))", (100100,), match="AI-Threat:", fields={"confidence": (LOW, MEDIUM)}, groups=_AI + ("ai_threat", "low_confidence")),
    Rule(100102, 8, "AI: Medium confidence threat detected ($(threat_type))", (100100,), match="AI-Threat:", fields={"confidence": (MEDIUM, HIGH)}, groups=_AI + ("ai_threat", "medium_confidence")),
    Rule(100103, 12, "AI: High confidence threat detected ($(threat_type))", (100100,), match="AI-Threat:", fields={"confidence": (HIGH, _INF)}, groups=_AI + ("ai_threat", "high_confidence")),
    _threat(100110, 10, "sql_injection", "SQL Injection attack"),
    _threat(100111, 10, "xss_attack", "XSS attack"),
    _threat(100112, 12, "command_injection", "Command injection attack"),
    _threat(100113, 9, "brute_force", "Brute force attack"),
    _threat(100114, 13, "malware", "Malware activity"),
    _threat(100115, 7, "port_scan", "Port scanning", ("ai_threat", "port_scan", "recon")),
    _threat(100116, 10, "web_attack", "Web attack"),
    _threat(100117, 6, "suspicious_activity", "Suspicious activity", ("ai_threat", "suspicious")),
    Rule(100120, 11, "AI: High anomaly score detected ($(threat_type)) from $(srcip)", _BANDS, fields={"anomaly_score": (0.8, _INF)}, groups=_AI + ("ai_threat", "high_anomaly")),
    Rule(222223, 3, "FortiGate: Traffic accepted from $(srcip)", decoded_as="fortigate-traffic", match='action="accept"', groups=_TRAFFIC),
    Rule(222224, 10, "FortiGate: Multiple connections detected from $(srcip). Blocking IP.", (222221,), frequency=4, timeframe=120, same_source_ip=True, groups=_TRAFFIC),
    Rule(222225, 3, "FortiGate: SSH session detected from $(srcip)", decoded_as="fortigate-custom", match='app="SSH"', groups=("fortigate_brute",)),
    Rule(222226, 10, "FortiGate: Brute Force detected from $(srcip). Blocking IP.", (222221,), frequency=3, timeframe=120, same_source_ip=True, groups=("fortigate_brute",)),
    Rule(222227, 3, "FortiGate log received.", decoded_as="fortigate-greedy", groups=("fortigate_fix",)),
    Rule(222228, 10, "FortiGate Brute Force: 3 attempts detected.", (222221,), frequency=3, timeframe=120, same_source_ip=True, groups=("fortigate_fix",)),
    Rule(444444, 15, "Brute Force Detected (PAM): 3 attempts from $(srcip)", (5503,), frequency=3, timeframe=120, same_source_ip=True, groups=("pam_brute",)),
    Rule(100200, 12, "🚨 LLM-CONFIRMED THREAT: $(llm_response)", fields={"llm_status": "analyzed", "llm_is_suspicious": 1, "llm_response": True}, groups=_REVIEW + ("ai_review", "threat", "suspicious")),
    Rule(100201, 8, "ℹ️ LLM Analysis (Requires Investigation): $(llm_response)", fields={"llm_status": "analyzed", "llm_is_suspicious": 0, "llm_response": True}, groups=_REVIEW + ("ai_review", "info")),
)
ALERT_LEVEL = 3


def with_bands(low: float = LOW, medium: float = MEDIUM, high: float = HIGH, rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """The rules with other edges of the confidence bands."""
    edges = {100101: (low, medium), 100102: (medium, high), 100103: (high, _INF)}
    return tuple(replace(r, fields={**r.fields, "confidence": edges[r.rule_id]}) if r.rule_id in edges else r for r in rules)


EMAIL_LEVEL = 12
EMAIL_RULES = (100200,)
NOTIFY_RULES = (100200, 100201)
EMAILS_PER_HOUR = 50
RESPONSES = (("quarantine", "server", 333333, None), ("firewall-drop", "server", 444444, 180), ("netsh", "all", 111111, 60))


def rules_from_table(df: DataFrame) -> list[Rule]:
    """Rules from a configuration table (rule_id, level, parents, decoded_as, match, fields,
    frequency, timeframe, same_source_ip, description, groups)."""
    out = []
    for r in df.collect():  # a configuration, not data
        d = r.asDict()
        out.append(Rule(
            d["rule_id"], d["level"], d["description"], tuple(d.get("parents") or ()), d.get("decoded_as"), d.get("match"),
            dict(d.get("fields") or {}), d.get("frequency"), d.get("timeframe"), bool(d.get("same_source_ip")), tuple(d.get("groups") or ()),
        ))
    return out


def _field(df: DataFrame, name: str, alias: dict[str, str]) -> Column | None:
    name = alias.get(name, name)
    return F.col(f"`{name}`") if name in df.columns else None


def _predicate(c: Column | None, want) -> Column:
    if c is None:
        return F.lit(False)
    if want is True:
        return F.coalesce(c.cast("string") != "", F.lit(False))
    if isinstance(want, tuple):
        x = c.try_cast("double")
        ok = x >= want[0]
        return F.coalesce(ok if want[1] == _INF else ok & (x < want[1]), F.lit(False))
    return F.coalesce(c.cast("string") == str(want), F.lit(False))


def render_description(df: DataFrame, template: str, alias: dict[str, str]) -> Column:
    """``$(field)`` slots filled from the row; an unknown or null field gives the empty text."""
    parts, rest = [], template
    while "$(" in rest:
        text, _, tail = rest.partition("$(")
        name, _, rest = tail.partition(")")
        c = _field(df, name, alias)
        parts += [F.lit(text), F.coalesce(c.cast("string"), F.lit("")) if c is not None else F.lit("")]
    return F.concat(*parts, F.lit(rest)) if parts else F.lit(template)


FIELD_ALIAS = {"threat_type": "threat_class", "anomaly_score": "dfp_score"}


def evaluate_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "log", decoder: str = "decoder", alias: dict[str, str] | None = None, fired_before: str | None = None) -> DataFrame:
    """One row per (event, rule that fired): the event columns plus rule_id, rule_level,
    rule_description and rule_groups, level-0 rules included.

    Frequency rules are left to ``frequency_rule``. ``fired_before`` names an array<int> column of
    rules that fired upstream and may serve as parents.
    """
    alias = FIELD_ALIAS if alias is None else alias
    single = [r for r in rules if r.frequency is None]
    known = {r.rule_id for r in single}
    depth: dict[int, int] = {}
    while len(depth) < len(single):
        ready = [r for r in single if r.rule_id not in depth and all(p not in known or p in depth for p in r.parents)]
        if not ready:
            raise ValueError("rules form a cycle")
        depth.update({r.rule_id: 1 + max([depth.get(p, 0) for p in r.parents], default=0) for r in ready})

    def condition(r: Rule) -> Column:
        ok = F.lit(True)
        if r.decoded_as is not None:
            ok = ok & (F.coalesce(F.col(decoder) == r.decoded_as, F.lit(False)) if decoder in df.columns else F.lit(False))
        if r.match is not None:
            ok = ok & (F.coalesce(F.contains(F.col(text), F.lit(r.match)), F.lit(False)) if text in df.columns else F.lit(False))
        for name, want in r.fields.items():
            ok = ok & _predicate(_field(df, name, alias), want)
        if r.parents:
            up = F.lit(False)
            for p in r.parents:
                if p in known:
                    up = up | F.col(f"_r{p}")
                elif fired_before:
                    up = up | F.coalesce(F.array_contains(fired_before, p), F.lit(False))
            ok = ok & up
        return ok

    out = df
    for level in sorted(set(depth.values())):  # parents are columns before their children read them
        out = out.withColumns({f"_r{r.rule_id}": condition(r) for r in single if depth[r.rule_id] == level})
    fired = F.array_compact(F.array(*[
        F.when(F.col(f"_r{r.rule_id}"), F.struct(
            F.lit(r.rule_id).alias("rule_id"), F.lit(r.level).alias("rule_level"),
            render_description(df, r.description, alias).alias("rule_description"),
            F.array(*[F.lit(g) for g in r.groups]).cast("array<string>").alias("rule_groups"),
        )) for r in single
    ]))
    return out.select(*df.columns, F.explode(fired).alias("_f")).select(*df.columns, "_f.*")


def confidence_band(confidence: Column, low: float = LOW, medium: float = MEDIUM, high: float = HIGH) -> Column:
    """Rule level of a confidence: 5, 8 or 12 from the edge of its band on."""
    return F.when(confidence >= high, 12).when(confidence >= medium, 8).when(confidence >= low, 5)


def frequency_rule(df: DataFrame, fired: Column, frequency: int, timeframe: int, key: str = "srcip", clock: str = "t", hot_rows: int | None = None) -> DataFrame:
    """Rows that complete ``frequency`` matches of a parent rule from one source within
    ``timeframe`` seconds, this row included. Adds ``matches``."""
    counted = range_counts(df.filter(fired & F.col(key).isNotNull()), [key], clock, timeframe, "matches", hot_rows)
    return counted.filter(F.col("matches") >= frequency)


def frequency_rules(df: DataFrame, fired: str = "fired_rules", rules: tuple[Rule, ...] = RULES, key: str = "srcip", clock: str = "t", hot_rows: int | None = None) -> DataFrame:
    """Every frequency rule of a table over an array<int> column of rules that fired: the row with matches, rule_id, rule_level
    and rule_description, once for each rule that it completes.

    One pass for all rules: each (parents, timeframe) is one count in the same exchange and sort, and the rules' numbers are
    compared afterwards.
    """
    counted = [r for r in rules if r.frequency is not None]
    flags = {p: f"_up{i}" for i, p in enumerate(dict.fromkeys(r.parents for r in counted))}
    counts = {(r.parents, r.timeframe): f"_n{i}" for i, r in enumerate(counted)}
    up = {name: F.coalesce(F.arrays_overlap(F.col(fired), F.array(*[F.lit(p) for p in parents]).cast("array<int>")), F.lit(False)) for parents, name in flags.items()}
    some = F.lit(False)
    for name in up:
        some = some | F.col(name)
    rows = df.withColumns(up).filter(some & F.col(key).isNotNull())
    rows = range_sums(rows, [key], clock, {out: (flags[p], seconds) for (p, seconds), out in counts.items()}, hot_rows)

    def completed(r: Rule) -> Column:
        n = F.col(counts[r.parents, r.timeframe])
        return F.when(F.col(flags[r.parents]) & (n >= r.frequency), F.struct(
            n.alias("matches"), F.lit(r.rule_id).alias("rule_id"), F.lit(r.level).alias("rule_level"), render_description(df, r.description, {}).alias("rule_description")))

    hits = F.array_compact(F.array(*map(completed, counted))).cast("array<struct<matches:bigint,rule_id:int,rule_level:int,rule_description:string>>")
    return rows.select(*df.columns, F.explode(hits).alias("_f")).select(*df.columns, "_f.*")


def suppress_rule(alerts: DataFrame) -> DataFrame:
    """Level-0 rules raise no alert."""
    return alerts.filter(F.col("rule_level") > 0)


def route_alerts(alerts: DataFrame) -> DataFrame:
    """One row per (alert, channel): alert log, e-mail, notification."""
    level, rule = F.col("rule_level"), F.col("rule_id")
    channels = F.array_compact(F.array(
        F.when(level >= ALERT_LEVEL, "alert"),
        F.when((level >= EMAIL_LEVEL) | rule.isin(*EMAIL_RULES), "email"),
        F.when(rule.isin(*NOTIFY_RULES), "notification"),
    ))
    return alerts.withColumn("channel", F.explode(channels))


def rate_cap(df: DataFrame, ts: str = "ts", tie: str = "event_id", cap: int = EMAILS_PER_HOUR) -> DataFrame:
    """Adds ``deferred``: 1 for rows after the first ``cap`` of their hour.

    Only the first ``cap`` rows per hour are ranked (limited before the shuffle); their last one is
    the hour's cut-off, a table with one row per hour, that every row is compared with.
    """
    hour = F.date_trunc("hour", ts)
    ranked = df.select(hour.alias("_hour"), ts, tie).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_hour").orderBy(ts, tie))).filter(F.col("_rn") <= cap)
    cut = ranked.groupBy("_hour").agg(F.max(F.struct(ts, tie)).alias("_cut"))
    return (
        df.withColumn("_hour", hour).join(F.broadcast(cut), "_hour", "left")  # 8,760 rows a year
        .withColumn("deferred", F.when(F.struct(ts, tie) > F.col("_cut"), 1).otherwise(0))
        .drop("_hour", "_cut")
    )


def response_action(alerts: DataFrame, responses=RESPONSES) -> DataFrame:
    """The response decided for each alert (command, location, timeout); nothing is executed."""
    schema = "command string, location string, rule_id int, timeout int"
    table = alerts.sparkSession.createDataFrame(list(responses), schema)  # a configuration of a few rows
    return alerts.join(F.broadcast(table), "rule_id")


def severity_level() -> Column:
    """Severity of a scored and reviewed event, highest reason first."""
    anomaly, suspicious = F.col("dfp_is_anomaly") == 1, F.col("llm_is_suspicious") == 1
    return (
        F.when(anomaly & suspicious, 14)
        .when(suspicious & (F.col("llm_confidence") >= 80), 13)
        .when(suspicious, 12)
        .when(F.col("threat_class") != "normal", 11)
        .when(anomaly, 10)
        .otherwise(8)
    )


def ioc_match(df: DataFrame, indicators: DataFrame, columns: tuple[str, ...], value: str = "indicator", tags: tuple[str, ...] = ("kind",)) -> DataFrame:
    """Rows of which any of ``columns`` is a listed indicator: adds ``ioc_column``, ``indicator`` and
    the list's tags, one row per hit.

    Spark picks the join by the list's size, and AQE splits values that very many rows share.
    """
    entries = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))) for c in columns]))
    long = df.withColumn("_e", F.explode(entries)).select(*df.columns, F.col("_e.c").alias("ioc_column"), F.col("_e.v").alias(value))
    listed = indicators.select(value, *tags).distinct()
    return long.join(listed, value)
