"""Signatures, classification, threat decisions and model-answer parsing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as C
from ..functions.fields import has, text_col
from ..functions.skew import lit_map


def detection_text(df: DataFrame, text_cols: tuple[str, ...] = ("full_log", "event_original", "msg"), chars: int | None = None) -> Column:
    """The text that signatures and classifier read: the whole log, or ``chars`` characters of it where a model's text
    format asks for that (``LOG_CHARS``)."""
    found = [F.col(c) for c in text_cols if has(df, c)]
    log = F.coalesce(*found, F.lit("")) if found else F.lit("")
    if chars is not None:
        log = F.substring(log, 1, chars)
    return F.concat(
        F.lit("Rule: "), text_col(df, "rule_id", ""), F.lit(" Level: "), text_col(df, "rule_level", "0"),
        F.lit(" Action: "), text_col(df, "fortinet_action", ""), F.lit(" Service: "), text_col(df, "fortinet_service", ""),
        F.lit(" Log: "), log,
    )


def _hit(text: Column, pattern: str) -> Column:
    # i: any case, u: Unicode case, d: only \n ends a line for "."
    return text.rlike("(?idu)" + pattern)


def _possible(low: str, ways: list[list[list[str]]]) -> Column:
    """Whether a text holds what some way to match needs: of each of its groups of literals at least one."""
    held = lambda group: reduce(Column.__or__, [F.contains(F.col(low), F.lit(x)) for x in group])
    return reduce(Column.__or__, [reduce(Column.__and__, map(held, way)) for way in ways])


def signature_match(df: DataFrame, text: str = "text", signatures=C.SIGNATURES, literals: list[list[list[list[str]]]] | None = None) -> DataFrame:
    """regex_match, regex_category, regex_confidence and regex_pattern of the first signature that
    matches in declared order.

    A signature's pattern runs only on texts that hold its necessary ``literals`` (plain
    substring searches on the lower-cased text: for some way to match, one literal of each group), or one of the few letters whose case folding that
    search does not see. Other signatures than the built-in ones run without this test unless
    their literals are given.
    """
    if literals is None and signatures is C.SIGNATURES:
        literals = C.SIGNATURE_LITERALS
    out = df
    if literals:
        low = F.lower(text)
        odd = F.contains(F.col(text), F.lit(C.FOLDING_LETTERS[0]))
        for x in C.FOLDING_LETTERS[1:]:
            odd = odd | F.contains(F.col(text), F.lit(x))
        out = out.withColumns({"_low": low, "_odd": odd})
    sig = F
    for i, (_, pattern) in enumerate(signatures):
        hit = _hit(F.col(text), pattern)
        if literals:
            hit = (F.col("_odd") | _possible("_low", literals[i])) & hit
        sig = sig.when(hit, F.lit(i))
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("_sig"))
    return out.withColumn("_sig", sig).withColumns({
        "regex_match": F.col("_sig").isNotNull(),
        "regex_category": pick([c for c, _ in signatures]),
        "regex_confidence": F.when(F.col("_sig").isNotNull(), C.SIGNATURE_CONFIDENCE),
        "regex_pattern": pick([p for _, p in signatures]),
    }).drop("_sig", "_low", "_odd")


def signature_all(text: Column, signatures=C.SIGNATURES) -> Column:
    """Every matching category, in declared order."""
    patterns: dict[str, list[str]] = {}
    for category, pattern in signatures:
        patterns.setdefault(category, []).append(pattern)
    flags = []
    for category, group in patterns.items():
        hit = _hit(text, group[0])
        for p in group[1:]:
            hit = hit | _hit(text, p)
        flags.append(F.when(hit, F.lit(category)))
    return F.array_compact(F.array(*flags))


# --- classification -------------------------------------------------------------------------

Logits = Callable[[np.ndarray], np.ndarray]

_CUES = {1: ("flood", "dos"), 2: ("scan", "sweep", "probe"), 3: ("trojan", "malware", "keylogger"), 4: ("password", "locked", "login")}


def keyword_logits() -> Logits:
    """Deterministic stand-in model: one logit per label from words in the text."""

    def predict(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), len(C.LABELS)), dtype=np.float64)
        out[:, 0] = 1.0
        for i, t in enumerate(texts):
            low = (t or "").lower()
            for label, words in _CUES.items():
                out[i, label] = 2.0 * sum(w in low for w in words)
        return out

    return predict


def model_logits(text: Column, make_model: Callable[[], Logits] = keyword_logits, batch_size: int = 128) -> Column:
    """Logits of a model over Arrow batches; null texts are not scored and give null.

    ``make_model`` runs once per Python worker and returns a function from an array of texts to a
    matrix of logits; text truncation to the model's token limit belongs to that function.
    """

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = make_model()
        for texts in batches:
            out = np.full(len(texts), None, dtype=object)
            asked = np.flatnonzero(texts.notna().to_numpy())
            for start in range(0, len(asked), batch_size):
                rows = asked[start : start + batch_size]
                out[rows] = list(np.asarray(predict(texts.to_numpy()[rows]), dtype=np.float64))
            yield pd.Series(out)

    return run(text)


def classify(df: DataFrame, text: str = "text", make_model: Callable[[], Logits] = keyword_logits, labels: list[str] = C.LABELS, batch_size: int = 128) -> DataFrame:
    """Adds class_id, threat_class and confidence from a plugged-in model."""
    scored = softmax_argmax(df.withColumn("logits", model_logits(F.col(text), make_model, batch_size)))
    return scored.withColumn("threat_class", label_lookup(F.col("class_id"), labels))


def softmax_argmax(df: DataFrame, logits: str = "logits") -> DataFrame:
    """probs, class_id (first maximum) and confidence from an array of logits."""
    top = F.array_max(logits)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return (
        df.withColumn("_e", F.transform(logits, lambda x: F.exp(x - top)))
        .withColumn("_s", total(F.col("_e")))
        .withColumns({
            "probs": F.transform("_e", lambda x: x / F.col("_s")),
            "class_id": (F.array_position(logits, top) - 1).cast("int"),
            "confidence": F.array_max("_e") / F.col("_s"),
        })
        .drop("_e", "_s")
    )


def label_lookup(class_id: Column, labels: list[str] = C.LABELS) -> Column:
    return F.coalesce(lit_map(dict(enumerate(labels)))[class_id], F.lit("unknown"))


def cascade(df: DataFrame, text: str = "text", make_model: Callable[[], Logits] = keyword_logits, labels: list[str] = C.LABELS, batch_size: int = 128) -> DataFrame:
    """Signatures first, the classifier only for rows without one: adds the ``regex_*`` columns,
    threat_class and confidence.

    One pass: the input is read once and each text is matched once. Rows with a signature enter
    the Python side as null and are skipped there.
    """
    matched = signature_match(df, text)
    ask = F.when(~F.col("regex_match"), F.col(text))
    scored = softmax_argmax(matched.withColumn("logits", model_logits(ask, make_model, batch_size)))
    hit = F.col("regex_match")
    return scored.withColumns({
        "threat_class": F.when(hit, F.col("regex_category")).otherwise(label_lookup(F.col("class_id"), labels)),
        "confidence": F.when(hit, F.col("regex_confidence")).otherwise(F.col("confidence")),
    }).drop("logits", "probs", "class_id")


# --- decisions ------------------------------------------------------------------------------

def classifier_threat() -> Column:
    return F.coalesce(F.col("threat_class") != "normal", F.lit(False))


def dfp_threat() -> Column:
    return F.coalesce((F.col("dfp_is_anomaly") == 1) & (F.col("dfp_score") > C.DFP_THREAT_SCORE), F.lit(False))


def threat_decision() -> Column:
    """1 when the class is not normal or the behaviour score is an anomaly above the threshold."""
    return F.when(classifier_threat() | dfp_threat(), 1).otherwise(0)


ARROW = " → "


# --- fixed values: what a result says where no behaviour score came in ---
RESULT_DEFAULTS = {
    "dfp_is_anomaly": 0, "dfp_score": 0.0, "dfp_individual_score": 0.0, "dfp_peer_score": 0.0, "dfp_status": "unknown",
    "dfp_peer_group_size": 0, "dfp_detection_method": "none", "full_log": "",
}


def threat_result(df: DataFrame, model_version: str = "hybrid_dfp_peer_v2") -> DataFrame:
    """Output columns of a ``cascade`` result; only signature hits carry ``detection_method``. Missing behaviour
    columns and nulls in them get their defaults."""
    hit = F.col("regex_match")
    # a full log that is absent is empty; everything else may come from either side of the chain
    filled = {n: F.coalesce(F.col(n), F.lit(v)) if has(df, n) else F.lit(v) for n, v in RESULT_DEFAULTS.items()}
    out = df.withColumns(filled).withColumn("threat_class", F.coalesce(F.nullif("threat_class", F.lit("")), F.lit("unknown")))
    out = out.withColumns({
        "is_threat": F.when(hit, 1).otherwise(threat_decision()),
        "stages_used": F.when(hit, "regex").otherwise(ARROW.join(["bert", "dfp"])),
        "detection_method": F.when(hit, "regex_pattern"),
        "model_version": F.lit(model_version),
    })
    stamps = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("@timestamp", "timestamp") if has(df, c)]
    if stamps:
        own = F.col("`@timestamp`").cast("string") if has(df, "@timestamp") else F.lit(None).cast("string")
        out = out.withColumn("@timestamp", F.when(hit, own).otherwise(F.coalesce(*stamps)))
    return out.drop("regex_match", "regex_category", "regex_confidence", "regex_pattern")


def anomaly_trigger() -> Column:
    """Which layer raised the anomaly: both, peer or individual; null without an anomaly."""
    return F.when(
        F.col("dfp_is_anomaly") == 1,
        F.when(F.col("dfp_detection_method") == "individual_and_peer", "both")
        .when(F.col("dfp_peer_score") > F.col("dfp_individual_score"), "peer")
        .otherwise("individual"),
    )


def threat_reasons() -> Column:
    """Readable grounds of a threat, joined by " | "."""
    group = F.coalesce(F.col("dfp_peer_group_id").cast("string"), F.lit("None"))
    return F.concat_ws(
        " | ",
        F.when(classifier_threat(), F.concat(F.lit("BERT:"), F.col("threat_class"))),
        F.when(dfp_threat(), F.format_string(
            "DFP:%.2f(ind=%.2f,peer=%.2f,group=%s)", "dfp_score", "dfp_individual_score", "dfp_peer_score", group)),
    )


def service_name(port: Column) -> Column:
    known = lit_map(C.SERVICE_NAMES)[port.try_cast("int")]
    return F.coalesce(known, F.concat(F.lit("port "), F.coalesce(port.cast("string"), F.lit("unknown"))))


def protocol_name(proto: Column) -> Column:
    known = lit_map(C.PROTOCOL_NAMES)[proto.try_cast("int")]
    return F.coalesce(known, F.concat(F.lit("Protocol "), F.coalesce(proto.cast("string"), F.lit("unknown"))))


def percent(score: Column) -> Column:
    """0.57 -> "57%"."""
    return F.concat(F.bround(score * 100, 0).cast("bigint").cast("string"), F.lit("%"))


def _fields(df: DataFrame) -> dict[str, Column]:
    out = {n: text_col(df, n, "unknown") for n in ("srcip", "dstip", "srcport", "dstport", "proto", "action", "app")}
    out.update({n: text_col(df, n, "0") for n in ("sentbyte", "rcvdbyte")})
    return out


def render_prompt(df: DataFrame, variant: str = "review") -> Column:
    """Question put to the analysis model: ``"detector"`` or ``"review"`` wording, the detector's behind its system text.
    For models with a chat form see ``chat_messages``."""
    if variant == "detector":
        return F.concat(F.lit(DETECTOR_SYSTEM + "\n\n"), _question(df, variant))
    return _question(df, variant)


def chat_messages(df: DataFrame, variant: str = "review") -> Column:
    """The question as an array of (role, content)."""
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    asked = said("user", _question(df, variant))
    return F.array(said("system", F.lit(DETECTOR_SYSTEM)), asked) if variant == "detector" else F.array(asked)


def _question(df: DataFrame, variant: str) -> Column:
    f, lit = _fields(df), F.lit
    if variant == "review":
        lines = [
            ("Source IP", "srcip"), ("Destination IP", "dstip"), ("Source Port", "srcport"), ("Destination Port", "dstport"),
            ("Protocol", "proto"), ("Action", "action"), ("Application", "app"), ("Bytes Sent", "sentbyte"), ("Bytes Received", "rcvdbyte"),
        ]
        body = [F.concat(lit(f"- {label}: "), f[name]) for label, name in lines]
        return F.concat_ws("\n", lit(REVIEW_INSTRUCTION), lit(""), lit("LOG DATA:"), *body)
    flagged = F.col("dfp_is_anomaly") == 1
    head = F.when(flagged, F.concat(
        lit("ALERT: DFP BEHAVIOURAL ANOMALY (score: "), percent(F.col("dfp_score")),
        lit(")\nEntity behaviour differs significantly from baseline and/or peer group."),
    )).otherwise(lit("ALERT: LOW CONFIDENCE DETECTION\nML classifier uncertain about this traffic pattern."))
    return F.concat(
        head, lit("\n\nNETWORK LOG:\n"), f["srcip"], lit(":"), f["srcport"], lit(ARROW), f["dstip"], lit(":"), f["dstport"],
        lit("\nProtocol: "), protocol_name(F.col("proto")), lit("\nService: "), service_name(F.col("dstport")),
        lit("\nAction: "), f["action"], lit("\nData: "), f["sentbyte"], lit("B sent, "), f["rcvdbyte"], lit("B received\n\n"),
        lit("TASK: Is this malicious traffic?\n" + DETECTOR_FORMAT),
    )


# --- fixed values: wording of the analysis questions ---
REVIEW_INSTRUCTION = (
    "You are a cybersecurity analyst. Analyze this network log and determine if it's a security threat.\n\n"
    "Respond ONLY with valid JSON in this exact format:\n"
    '{"is_threat": true/false, "confidence": 0-100, "reason": "Brief explanation of the threat"}'
)
DETECTOR_SYSTEM = (
    "You are a cybersecurity analyst. Analyse network logs concisely. Focus on: unusual ports, suspicious protocols, "
    "data exfiltration patterns, known attack signatures."
)
DETECTOR_FORMAT = 'Answer in JSON: {"is_threat": true/false, "confidence": 0-100, "reason": "one sentence"}'


# --- answers --------------------------------------------------------------------------------

_OBJECT = r'(?s)\{[^}]*"is_threat"[^}]*\}'
_ANSWER = "is_threat string, confidence string, reason string, _bad string"


def _mentions(text: Column, words: list[str]) -> Column:
    low = F.lower(text)
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(low, F.lit(w))
    return hit


def parse_verdict(df: DataFrame, answer: str = "answer") -> DataFrame:
    """verdict_threat (0/1), verdict_confidence, verdict_reason and verdict_trigger from an answer.

    An embedded JSON object decides; without one, keywords do; malformed JSON falls back to the
    word "true"; a confidence that is no number marks the answer as an error.
    """
    text = F.col(answer)
    out = df.withColumn("_obj", F.regexp_extract(text, _OBJECT, 0))
    out = out.withColumn("_j", F.when(F.col("_obj") != "", F.from_json("_obj", _ANSWER, {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"})))
    flag, conf = F.col("_j.is_threat"), F.trim(F.col("_j.confidence"))
    quoted_flag = F.col("_obj").rlike(r'"is_threat"\s*:\s*"')
    truthy = F.when(quoted_flag, flag != "").otherwise(~flag.isin("false", "0", "0.0", "null", "[]"))
    has_conf = F.col("_obj").rlike(r'"confidence"\s*:')
    quoted_conf = F.col("_obj").rlike(r'"confidence"\s*:\s*"')
    number = F.when(quoted_conf, F.when(conf.rlike(r"^[+-]?\d+(_\d+)*$"), F.regexp_replace(conf, "_", "").try_cast("bigint"))).otherwise(
        F.when(conf == "true", F.lit(1)).when(conf == "false", F.lit(0)).otherwise(conf.try_cast("double").try_cast("bigint"))
    )
    form = (
        F.when(F.col("_obj") == "", "keywords")
        .when(F.col("_j._bad").isNotNull() | F.col("_j").isNull(), "broken")
        .when(has_conf & number.isNull(), "error")
        .otherwise("json")
    )
    out = out.withColumns({"_form": form, "_truthy": F.coalesce(truthy, F.lit(False)), "_number": F.coalesce(number, F.lit(50))})
    words, true_word = _mentions(text, C.VERDICT_KEYWORDS), F.contains(F.lower(text), F.lit("true"))
    form = F.col("_form")
    threat = F.when(form == "keywords", words).when(form == "broken", true_word).when(form == "json", F.col("_truthy")).otherwise(F.lit(False))
    confidence = (
        F.when(form == "keywords", F.when(words, 80).otherwise(20))
        .when(form == "broken", F.when(true_word, 70).otherwise(30))
        .when(form == "json", F.col("_number"))
        .otherwise(0)
    )
    # a reason that is there and null stays null
    reason = F.when(form == "json", F.coalesce(F.col("_j.reason"), F.when(~F.col("_obj").rlike(r'"reason"\s*:'), "No reason provided"))).when(
        form == "error", F.concat(F.lit("error: confidence is not a number: "), F.coalesce(conf, F.lit("null")))).otherwise(text)
    return out.withColumns({
        "verdict_threat": F.when(threat, 1).otherwise(0),
        "verdict_confidence": confidence.cast("bigint"),
        "verdict_reason": reason,
        "verdict_trigger": F.when(form == "error", "error").otherwise(review_trigger()),
    }).drop("_obj", "_j", "_form", "_truthy", "_number")


def review_trigger(low: str = "low_bert_conf") -> Column:
    """Why a row was analyzed: its behaviour score or a low classifier confidence."""
    return F.when(F.col("dfp_is_anomaly") == 1, "dfp_anomaly").otherwise(low)


def parse_verdict_keywords(df: DataFrame, answer: str = "answer") -> DataFrame:
    """The detector's simpler reading: keywords decide, confidence from a ``"confidence": n`` part."""
    threat = _mentions(F.col(answer), C.DETECTOR_KEYWORDS)
    digits = F.regexp_extract(answer, r'"confidence":\s*(\d+)', 1)
    return df.withColumns({
        "verdict_threat": F.when(threat, 1).otherwise(0),
        "verdict_confidence": F.coalesce(digits.try_cast("bigint"), F.when(threat, 75).otherwise(50)).cast("bigint"),
        "verdict_trigger": review_trigger("low_bert_confidence"),
    })
