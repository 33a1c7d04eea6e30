"""Alert selection and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import text_col


def alert_candidates(docs: DataFrame, original: str = "event_original") -> DataFrame:
    """Suspicious documents with an answer and their original line."""
    return docs.filter(
        (F.col("llm_is_suspicious") == 1) & F.col("llm_response").isNotNull() & (F.col("llm_response") != "") & F.col(original).isNotNull())


def latest_alerts(docs: DataFrame, size: int = 10, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The newest candidates, as a distributed top-k."""
    return alert_candidates(docs).orderBy(F.desc(ts), F.desc(tie)).limit(size)


def unseen_alerts(alerts: DataFrame, sent: DataFrame, key: str = "doc_id") -> DataFrame:
    """Alerts whose id is not in the table of sent ones, each id once."""
    return alerts.join(sent.select(key), key, "left_anti").dropDuplicates([key])


# --- fixed values: severity steps (from confidence, name, colour, sign) ---
SEVERITIES = ((90, "CRITICAL", 0x8B0000, "🚨"), (70, "HIGH", 0xFF0000, "⚠️"), (50, "MEDIUM", 0xFF6600, "⚡"))
LOWEST = ("LOW", 0xFFCC00, "💡")


def _step(confidence: Column, i: int) -> Column:
    out = F
    for step in SEVERITIES:
        out = out.when(confidence >= step[0], step[i + 1])
    return out.otherwise(LOWEST[i])


def alert_severity(df: DataFrame, product: str = "AI") -> DataFrame:
    """severity, color and title from the review confidence."""
    c = F.coalesce(F.col("llm_confidence").try_cast("int"), F.lit(0))
    out = df.withColumns({"severity": _step(c, 0), "color": _step(c, 1)})
    return out.withColumn("title", F.concat(_step(c, 2), F.lit(f" {product} Alert — "), F.col("severity")))


def kilobytes(count: Column) -> Column:
    """Bytes in KB with two decimals, exact halves to the even digit, e.g. ``0.12`` or ``3.0``."""
    n = F.coalesce(count.try_cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    kb = F.bround((n / F.lit(1024).cast("decimal(4,0)")).cast("decimal(38,10)"), 2).cast("decimal(30,2)").cast("string")
    return F.regexp_replace(kb, r"^(-?\d+\.\d)0$", "$1")


def format_traffic(df: DataFrame) -> DataFrame:
    return df.withColumns({"sent_kb": kilobytes(F.col("sentbyte")), "received_kb": kilobytes(F.col("rcvdbyte"))})


def render_alert(df: DataFrame, product: str = "AI", footer: str = "Hybrid behaviour and language-model review") -> DataFrame:
    """Adds ``message``: title, color, description, five sections and a footer."""
    out = format_traffic(alert_severity(df, product))
    na = lambda n: text_col(df, n, "N/A")
    code = lambda c: F.concat(F.lit("`"), c, F.lit("`"))

    def section(name: str, rows: list[tuple[str, Column]]) -> Column:
        lines = [F.concat(F.lit(f"**{label}:** "), code(c)) for label, c in rows]
        return F.struct(F.lit(name).alias("name"), F.concat_ws("\n", *lines).alias("value"), F.lit(False).alias("inline"))

    end = lambda ip, port: F.concat(na(ip), F.lit(":"), na(port))
    flagged = F.coalesce(F.col("dfp_is_anomaly").try_cast("int"), F.lit(0)) != 0
    fields = F.array(
        section("🔎 Detection Signals", [
            ("LLM Suspicious", text_col(df, "llm_is_suspicious", "0")),
            ("LLM Confidence", F.concat(text_col(df, "llm_confidence", "0"), F.lit("%"))),
            ("Trigger", text_col(df, "llm_trigger", "unknown"))]),
        section("🌐 Network Traffic", [
            ("Src", end("srcip", "srcport")), ("Dst", end("dstip", "dstport")),
            ("Proto", na("proto")), ("App", na("app")), ("Action", na("action"))]),
        section("📊 Traffic Stats", [
            ("Sent", F.concat("sent_kb", F.lit(" KB"))), ("Received", F.concat("received_kb", F.lit(" KB"))), ("Duration", na("duration"))]),
        section("🔍 Firewall Policy", [
            ("Policy ID", na("policyid")), ("Policy Name", na("policyname")), ("Src Intf", na("srcintf")), ("Dst Intf", na("dstintf"))]),
        section("🧬 DFP Analysis", [
            ("Anomaly", F.when(flagged, "YES ⚠️").otherwise("NO")), ("DFP Score", na("dfp_score")), ("Original Class", na("threat_class"))]),
    )
    message = F.struct(
        F.col("title"), F.col("color"), F.concat(F.lit("**🤖 LLM Analysis:**\n"), text_col(df, "llm_response", "No LLM analysis")).alias("description"),
        fields.alias("fields"), F.struct(F.lit(footer).alias("text")).alias("footer"))
    return out.withColumn("message", message)
