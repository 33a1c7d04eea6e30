"""Gating and carrying out the second-opinion analysis."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as C
from ..functions.fields import has
from ..functions.skew import range_counts
from ..session import materialize
from .detect import parse_verdict, review_trigger

LANE_ROWS = 500_000  # ticks of long chains for each lane of keys


def _or(df: DataFrame, name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default)) if has(df, name) else F.lit(default)


def needs_review(df: DataFrame) -> Column:
    """True for a strong behaviour anomaly or a low classifier confidence."""
    strong = (_or(df, "dfp_is_anomaly", 0) == 1) & (_or(df, "dfp_score", 0.0) > C.REVIEW_SCORE)
    return strong | (_or(df, "confidence", 1.0) < C.REVIEW_CONFIDENCE)


def gate_key(df: DataFrame, keys: list[str]) -> Column:
    """Key of a gate; missing parts share the empty text."""
    return F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def _fold(ticks: Column, cooldown: int, tie_type: str) -> Column:
    """Ticks that pass, walking an ordered array of (t, first_tie): the first one, then each at
    least ``cooldown`` after the last that passed."""
    step = lambda acc, x: F.when(
        (F.size(acc) == 0) | (x["t"] - F.element_at(acc, -1)["t"] >= cooldown), F.array_append(acc, x)
    ).otherwise(acc)
    return F.aggregate(ticks, F.array().cast(f"array<struct<t:bigint,first_tie:{tie_type}>>"), step)


def _dense_passes(slots: DataFrame, cooldown: int, tie_type: str, lanes: int) -> DataFrame:
    """Passes of chains too long for one array. Blocks of a key are reduced side by side to small
    tables of (possible first pass, last pass); one short walk per key links the blocks; a second
    side-by-side step marks the passes. A Python group is one block of the clock for all keys of a lane."""
    width = cooldown * 144
    lane = F.pmod(F.hash("k"), F.lit(lanes)).alias("lane")
    blocks = slots.select("*", F.expr(f"(t - pmod(t, {width})) div {width}").alias("block"), lane)

    def parts(pdf: pd.DataFrame, by: list[str]) -> Iterator[tuple[str, pd.DataFrame]]:
        pdf = pdf.sort_values(["k", *by], kind="stable").reset_index(drop=True)
        k = pdf["k"].to_numpy()
        edges = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1), len(k)]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                yield k[lo], pdf.iloc[lo:hi]

    def exits(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        limit, out = key[1] * width + cooldown, []
        for k, part in parts(pdf, ["t"]):
            t = part["t"].to_numpy()
            nxt = np.searchsorted(t, t + cooldown, side="left")
            last = np.arange(len(t))
            for i in range(len(t) - 1, -1, -1):
                if nxt[i] < len(t):
                    last[i] = last[nxt[i]]
            # last + cooldown lies before block start + cooldown, so later times never pass first,
            # except the first time after that point when nothing lies before it
            n = min(int(np.searchsorted(t, limit, side="left")) + 1, len(t))
            first, leave = t[:n], t[last[:n]]
            # several first passes with one exit: only the latest of them matters to the search
            keep = np.r_[leave[1:] != leave[:-1], True]
            out.append(pd.DataFrame({"k": k, "block": key[1], "first": first[keep], "exit": leave[keep]}))
        return pd.concat(out, ignore_index=True)

    def enter(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for k, part in parts(pdf, ["block", "first"]):
            last, block = -(2**62), part["block"].to_numpy()
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1), len(block)]
            first, leave = part["first"].to_numpy(), part["exit"].to_numpy()
            for lo, hi in zip(edges, edges[1:]):
                rows.append((k, int(block[lo]), int(last)))
                i = lo + int(np.searchsorted(first[lo:hi], last + cooldown, side="left"))
                if i < hi:
                    last = int(leave[i])
        return pd.DataFrame(rows, columns=["k", "block", "last_in"])

    def mark(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in parts(pdf, ["t"]):
            t = part["t"].to_numpy()
            i, hit = int(np.searchsorted(t, int(part["last_in"].iloc[0]) + cooldown, side="left")), []
            while i < len(t):
                hit.append(i)
                i = int(np.searchsorted(t, t[i] + cooldown, side="left"))
            out.append(part.iloc[hit][["k", "t", "first_tie"]])
        return pd.concat(out, ignore_index=True)

    steps = blocks.select("lane", "k", "block", "t").groupBy("lane", "block").applyInPandas(exits, "k string, block bigint, first bigint, exit bigint")
    entries = steps.select("*", lane).groupBy("lane").applyInPandas(enter, "k string, block bigint, last_in bigint")
    return (
        blocks.select("lane", "k", "block", "t", "first_tie").join(entries, ["k", "block"])
        .groupBy("lane", "block").applyInPandas(mark, f"k string, t bigint, first_tie {tie_type}")
    )


def cooldown_gate(df: DataFrame, keys: list[str], clock: str = "t", tie: str = "event_id", cooldown: int = C.COOLDOWN_SECONDS, long_chain: int = 1_000) -> DataFrame:
    """Adds ``gate_pass``: 1 when at least ``cooldown`` has gone by since the last row of the same
    key that passed. ``clock`` is an integer column in the unit of ``cooldown`` (seconds).

    Of the rows sharing key and clock only the first (by ``tie``) can pass, so rows are first
    reduced to (key, clock) with map-side combine; what is ordered per key is at most one row per
    clock tick, however hot the key. A gap of ``cooldown`` always starts a new chain, and chains
    are independent. Short chains fold in the JVM, which costs their length squared; chains above
    ``long_chain`` ticks are cut into blocks, which is linear. The reduced ticks are stored once.
    """
    e = df.withColumn("_k", gate_key(df, keys))
    slots = e.groupBy(F.col("_k").alias("k"), F.col(clock).cast("bigint").alias("t")).agg(F.min(tie).alias("first_tie"))
    order = Window.partitionBy("k").orderBy("t")
    gap = F.col("t") - F.lag("t").over(order)
    chained = (
        slots.withColumn("_new", F.when(gap.isNull() | (gap >= cooldown), F.col("t")))
        .withColumn("chain", F.max("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_len", F.count("*").over(Window.partitionBy("k", "chain")))
        .select("k", "t", "first_tie", "chain", "_len")
    )
    chained = materialize(chained, "ticks")
    tie_type = dict(df.dtypes)[tie]
    short = (
        chained.filter(F.col("_len") <= long_chain)
        .groupBy("k", "chain").agg(F.sort_array(F.collect_list(F.struct("t", "first_tie"))).alias("ticks"))
        .select("k", F.explode(_fold(F.col("ticks"), cooldown, tie_type)).alias("x")).select("k", "x.*")
    )
    long = chained.filter(F.col("_len") > long_chain)
    n = long.count()
    passes = short.unionByName(_dense_passes(long, cooldown, tie_type, -(-n // LANE_ROWS))) if n else short
    passes = passes.select(
        F.col("k").alias("_k"), F.col("t").alias("_t"), F.col("first_tie").alias("_tie"), F.lit(1).alias("gate_pass"))
    cond = (F.col("p._k") == F.col("e._k")) & (F.col("p._t") == F.col(f"e.{clock}").cast("bigint")) & (F.col("p._tie") == F.col(f"e.{tie}"))
    return e.alias("e").join(passes.alias("p"), cond, "left").select(
        *[F.col(f"e.`{c}`") for c in df.columns], F.coalesce("gate_pass", F.lit(0)).alias("gate_pass"))


def review_status(df: DataFrame, key: str = "srcip", clock: str = "t", tie: str = "event_id", cooldown: int = C.COOLDOWN_SECONDS) -> DataFrame:
    """llm_status of every row: skipped_threshold, skipped_cooldown or analyzed.

    Only rows above the threshold reach the gate; the others never touch its shuffle.
    """
    need = needs_review(df)
    below = df.filter(~need).withColumns({
        "llm_status": F.lit("skipped_threshold"), "llm_is_suspicious": F.lit(0), "llm_reason": F.lit(None).cast("string")})
    gated = cooldown_gate(df.filter(need), [key], clock, tie, cooldown)
    passed = F.col("gate_pass") == 1
    gated = gated.withColumns({
        "llm_status": F.when(passed, "analyzed").otherwise("skipped_cooldown"),
        "llm_is_suspicious": F.when(passed, F.lit(None).cast("int")).otherwise(1),
        "llm_reason": F.when(passed, F.lit(None).cast("string")).otherwise(C.COOLDOWN_REASON),
    }).drop("gate_pass")
    return below.unionByName(gated)


def enrichment_record(df: DataFrame, now: Column | None = None, stamp: str = "@timestamp", zone_hours: int = 7) -> DataFrame:
    """Base record of an analysis result, stamped with ``now`` (a UTC timestamp) at UTC+7."""
    at = F.current_timestamp() if now is None else now
    sign = "+" if zone_hours >= 0 else "-"
    text = F.concat(
        F.date_format(at + F.make_dt_interval(hours=F.lit(zone_hours)), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit(f"{sign}{abs(zone_hours):02d}:00"),
    )
    return df.select(
        F.col(f"`{stamp}`").alias("@timestamp"), "srcip", "dstip", F.col("threat_class").alias("original_threat_class"),
        _or(df, "dfp_is_anomaly", 0).alias("dfp_is_anomaly"), _or(df, "dfp_score", 0.0).alias("dfp_score"),
        text.alias("enrichment_timestamp"),
        *[c for c in df.columns if c in ("event_id", "confidence", "llm_status", "llm_is_suspicious", "llm_reason", "llm_confidence", "llm_response", "llm_trigger")],
    )


Analyst = Callable[[pd.Series], pd.Series]


def keyword_analyst() -> Analyst:
    """Deterministic stand-in for a text model: answers in the JSON form asked for."""

    def answer(prompts: pd.Series) -> pd.Series:
        bad = prompts.str.contains("deny|Port: 22\n|score: (?:9[0-9]|100)%", regex=True)
        return bad.map({
            True: '{"is_threat": true, "confidence": 85, "reason": "matches a known risk"}',
            False: '{"is_threat": false, "confidence": 15, "reason": "ordinary traffic"}',
        })

    return answer


def analyze(df: DataFrame, prompt: str = "prompt", make_analyst: Callable[[], Analyst] = keyword_analyst, partitions: int | None = None) -> DataFrame:
    """Adds ``answer`` by running an analyst over Arrow batches of the gated rows.

    Gated rows are few and slow, so they are spread evenly first (``partitions``).
    """
    schema = T.StructType([*df.schema.fields, T.StructField("answer", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make_analyst()
        for pdf in batches:
            yield pdf.assign(answer=ask(pdf[prompt]).astype(object) if len(pdf) else pd.Series(dtype=object))

    spread = df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInPandas(run, schema)


def attach_verdict(df: DataFrame, answer: str = "answer") -> DataFrame:
    """llm_* columns of analyzed rows from their answers."""
    v = parse_verdict(df, answer)
    return v.withColumns({
        "llm_is_suspicious": F.col("verdict_threat"), "llm_confidence": F.col("verdict_confidence"),
        "llm_response": F.col("verdict_reason"), "llm_trigger": F.col("verdict_trigger"),
    }).drop(answer, "verdict_threat", "verdict_confidence", "verdict_reason", "verdict_trigger")


def signature_cooldown(df: DataFrame, clock: str = "t", tie: str = "event_id", keys: tuple[str, ...] = ("srcip", "dstip", "dstport", "action", "app"), cooldown: int = C.COOLDOWN_SECONDS) -> DataFrame:
    """The gate keyed by the full behaviour signature."""
    return cooldown_gate(df, list(keys), clock, tie, cooldown)


def multi_log_pattern(df: DataFrame, keys: list[str], clock: str = "t", seconds: int = C.PATTERN_SECONDS, events: int = C.PATTERN_EVENTS, hot_rows: int | None = None) -> DataFrame:
    """Adds ``pattern_count`` and ``is_pattern``: enough events of the key inside the window."""
    out = range_counts(df, keys, clock, seconds, "pattern_count", hot_rows)
    return out.withColumn("is_pattern", F.when(F.col("pattern_count") >= events, 1).otherwise(0))


def review_decision(df: DataFrame, clock: str = "t", tie: str = "event_id", hot_rows: int | None = None) -> DataFrame:
    """The documented decision order: recent same signature, multi-log pattern, high score, else skip."""
    gated = multi_log_pattern(signature_cooldown(df, clock, tie), ["srcip"], clock, hot_rows=hot_rows)
    return gated.withColumn(
        "decision",
        F.when(F.col("gate_pass") == 0, "skip_same_signature")
        .when(F.col("is_pattern") == 1, "analyze_pattern")
        .when(F.col("dfp_score") > C.DFP_THREAT_SCORE, "analyze_score")
        .otherwise("skip"),
    )


__all__ = [
    "analyze", "attach_verdict", "cooldown_gate", "enrichment_record", "keyword_analyst", "multi_log_pattern",
    "needs_review", "review_decision", "review_status", "review_trigger", "signature_cooldown",
]
