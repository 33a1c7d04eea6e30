"""Boundary values and parity with the Python standard library."""

import ipaddress
import re

import pytest
from pyspark.sql import functions as F

from logvigil.functions import constants as C
from logvigil.functions import fields as FI
from logvigil.operators import alerts as A
from logvigil.operators import detect as D
from logvigil.operators import features as FE
from logvigil.operators import index as I
from logvigil.operators import models as MO
from logvigil.operators import parse as P
from logvigil.operators import peers as PE
from logvigil.operators import review as R
from logvigil.operators import rules as RU
from logvigil.sources import io


def one(spark, values, dtype, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


V4 = ["9.255.255.255", "10.0.0.0", "172.15.255.255", "172.16.0.0", "172.31.255.255", "172.32.0.0", "192.0.0.9", "192.0.0.11", "192.0.0.8",
      "100.64.0.1", "8.8.8.8", "256.1.1.1", "010.0.0.1", "", None, "1.2.3", "1.2.3.4.5", " 10.0.0.1", "0.0.0.0", "255.255.255.255", "239.1.1.1", "240.0.0.1"]
V6 = ["::1", "::", "::2", "fe80::1", "fe80::1%eth0", "fec0::1", "fc00::", "fdff::1", "fe00::1", "2001:db8::1", "2001:db9::1", "2001::1", "2001:1ff::1", "2001:200::1",
      "2001:1::1", "2001:1::2", "2001:1::3", "2001:3::5", "2001:4:112::1", "2001:20::1", "2001:30::1", "2002::1", "64:ff9b:1::1", "64:ff9b::1", "100::1", "100:0:0:1::1",
      "::ffff:10.0.0.1", "::ffff:8.8.8.8", "::ffff:808:808", "::ffff:a00:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", ":::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
      "12345::1", "g::1", "2001:4860:4860::8888", "1:2:3:4:5:6:1.2.3.4", "::1.2.3.400", ":1:2:3:4:5:6:7", "FE80::ABCD", "10.0.0.1\n", "fe80::1\n", "1:2:3:4:5:6:7:8:9", "3ffe::1"]


def python_private(ip):
    try:
        return ipaddress.ip_address(ip).is_private
    except ValueError:
        return False


def test_private_ip(spark):
    ips = V4 + V6
    got = one(spark, ips, "string", lambda c: FI.is_private_ip("v"))
    assert dict(zip(ips, got)) == {ip: python_private(ip) for ip in ips}


def test_private_ip_all_first_octets(spark):
    ips = [f"{a}.{b}.{c}.7" for a in range(0, 256, 3) for b in (0, 2, 16, 18, 51, 64, 168, 254) for c in (0, 2, 100, 113)]
    assert one(spark, ips, "string", lambda c: FI.is_private_ip("v")) == [python_private(ip) for ip in ips]


def test_safe_float(spark):
    texts = ["1", " 2.5 ", "-3e2", "1_000", "1d", "1f", "", "abc", None, ".5", "5.", "+7", "1__0", "0x1", "inf", "-Infinity", "1e400", "_1"]

    def want(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return 0.0

    assert one(spark, texts, "string", FI.safe_float_text) == [want(v) for v in texts]
    nan = one(spark, ["nan"], "string", FI.safe_float_text)[0]
    assert nan != nan


@pytest.mark.parametrize("category,pattern", C.SIGNATURES)
def test_signature_parity(spark, sf_dir, category, pattern):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()][:120]
    texts += ["UNION\nSELECT", "union all select", "or a\u0085=1", "OR x = y", "DROP TABLE", "delete from", "TROJAN", "ſcript", "a|b", "x && y", "..\\up", "`id`", "$(id)",
              "failed x password 5 times", "too many login attempts", "<SCRIPT>", "cmd.exe", "path to traversal", "SYN a flood", "Kfailed", ""]
    rx = re.compile(pattern, re.IGNORECASE)
    got = one(spark, texts, "string", lambda c: c.rlike("(?idu)" + pattern))
    assert got == [bool(rx.search(t)) for t in texts]


def test_kilobytes(spark):
    counts = [0, 1, 5, 128, 384, 640, 896, 1024, 1100, 2755, 10_000_000, 123_456_789_012, 1152, 3200]
    assert one(spark, counts, "bigint", A.kilobytes) == [str(round(n / 1024, 2)) for n in counts]
    assert one(spark, [None], "bigint", A.kilobytes) == ["0.0"]


ANSWERS = [
    ('{"is_threat": true, "confidence": 85, "reason": "scan"}', 1, 85), ('Sure. {"is_threat": false, "confidence": 10, "reason": "ok"} done', 0, 10),
    ('{"is_threat": true, "reason": "x"}', 1, 50), ("This looks malicious", 1, 80), ("All fine here", 0, 20), ('{"is_threat": true, "confidence": }', 1, 70),
    ('{"is_threat": no, "confidence": 5}', 0, 30), ('{"is_threat": true, "confidence": "85%"}', 0, 0), ('{"is_threat": "no", "confidence": "7"}', 1, 7),
    ('{"is_threat": 0, "confidence": 12.9}', 0, 12), ('{"is_threat": true, "confidence": null}', 0, 0), ('{"is_threat": null, "confidence": 4}', 0, 4), ("", 0, 20),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, a, 0) for i, (a, _, _) in enumerate(ANSWERS)], "i int, answer string, dfp_is_anomaly int")
    got = D.parse_verdict(df).orderBy("i").collect()
    assert [(r.verdict_threat, r.verdict_confidence) for r in got] == [(t, c) for _, t, c in ANSWERS]
    assert got[7].verdict_trigger == "error" and got[0].verdict_trigger == "low_bert_conf"


def test_review_boundaries(spark):
    df = spark.createDataFrame([(1, 0.98, 0.9), (1, 0.9800001, 0.9), (0, 0.99, 0.9), (0, 0.0, 0.40), (0, 0.0, 0.3999), (None, None, None)], "dfp_is_anomaly int, dfp_score double, confidence double")
    assert [r.x for r in df.select(R.needs_review(df).alias("x")).collect()] == [False, True, False, False, True, False]


def test_cooldown_boundary(spark):
    e = spark.createDataFrame([(1, "a", 0), (2, "a", 599), (3, "a", 600), (4, "a", 1199), (5, "a", 1200), (6, None, 0), (7, "", 10), (8, "b", 0), (9, "b", 0)], "event_id int, srcip string, t bigint")
    got = {r.event_id: r.gate_pass for r in R.cooldown_gate(e, ["srcip"]).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 1, 7: 0, 8: 1, 9: 0}


def test_threat_boundary(spark):
    df = spark.createDataFrame([("normal", 1, 0.70), ("normal", 1, 0.7001), ("normal", 0, 0.9), ("DoS", 0, 0.0)], "threat_class string, dfp_is_anomaly int, dfp_score double")
    assert [r.x for r in df.select(D.threat_decision().alias("x")).collect()] == [0, 1, 0, 1]


def test_bands(spark):
    values = [0.59, 0.60, 0.7499, 0.75, 0.90, 0.9000001, 0.94, 0.95]
    assert one(spark, values, "double", RU.confidence_band) == [None, 5, 5, 8, 8, 8, 8, 12]
    assert one(spark, values, "double", lambda c: RU.confidence_band(c, high=0.9000001)) == [None, 5, 5, 8, 8, 12, 12, 12]


def test_kv(spark):
    line = 'a=1 b="x y" c="k=v" a=1 d= e="" b=z junk f=g=h "q"=w'
    assert one(spark, [line, None], "string", P.parse_kv) == [{"a": "1", "b": "z", "c": "k=v", "d": "", "e": "", "f": "g=h", "q": "w"}, None]


def test_parse_line(spark):
    line = '<189>date=2024-01-01 time=07:00:00 devname="FG 1" srcip=10.0.0.8 srcport=1024 dstip=8.8.4.9 dstport=443 proto=6 action="accept" sentbyte=655 rcvdbyte=333 policyid=7 url="a=b"'
    r = P.parse_firewall(spark.createDataFrame([(line,)], "value string")).first()
    assert (r.syslog_facility, r.syslog_severity, r.srcport, r.devname, r.sentbyte, r.extra) == ("local7", "notice", 1024, "FG 1", "655", {"url": "a=b"})
    assert str(r["@timestamp"]) == "2024-01-01 00:00:00" and r.event_original == line


def test_event_time(spark):
    df = spark.createDataFrame([("2024-01-01T23:30:00+07:00", "x", 5), ("", "2024-01-06 01:00:00", 5), (None, None, 1704103200), (None, "", 1704103200000), ("bad", "2024-01-01", 5), (None, None, 0)],
                               "`@timestamp` string, timestamp string, eventtime bigint")
    hours = lambda mode: [r.h for r in df.select(F.hour(FI.event_time(df, hour_mode=mode)).alias("h")).collect()]
    assert hours("offset") == [23, 1, 10, 10, None, None]
    assert hours("utc") == [16, 1, 10, 10, None, None]


def test_night_and_weekend_without_time(spark):
    r = FE.temporal_features(spark.createDataFrame([("x",)], "timestamp string")).first()
    assert (r.hour, r.day_of_week, r.is_weekend, r.is_business_hours, r.is_night) == (0, 0, 0, 0, 0)


def test_feature_sets():
    assert len(C.TRAFFIC_FEATURES) == 34 and len(C.UTM_FEATURES) == 24 and len(set(C.TRAFFIC_FEATURES)) == 34


def test_group_count(spark):
    assert one(spark, [3, 29, 30, 40, 499, 500, 9000], "bigint", PE.group_count) == [3, 3, 3, 4, 49, 50, 50]


def test_network_learns():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(15, 34))
    flat = MO._train_autoencoder(x)
    assert len(flat) == sum(int(np.prod(s)) for s in MO._shapes(34).values())
    assert np.isfinite(MO._autoencoder_errors(flat, x)).all()
    np.testing.assert_allclose(MO._train_autoencoder(x), flat)
    # gradients point downhill: more steps, smaller training error
    before, MO.EPOCHS = MO.EPOCHS, 400
    try:
        assert MO._autoencoder_errors(MO._train_autoencoder(x), x).mean() < MO._autoencoder_errors(flat, x).mean()
    finally:
        MO.EPOCHS = before
    pca = MO._train_pca(x)
    assert MO._pca_errors(pca, x).max() < 2.0


def test_json_modes(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": ',), ("[]",)], "value string")
    assert [r.a for r in io.decode_json(df, "a int").collect()] == [1]
    assert [r._corrupt for r in io.decode_json(df, "a int", on_error="only").collect()][0] == '{"a": '
    assert io.decode_json(df, "a int", on_error="keep").count() == 3


def test_search_wildcards(spark):
    df = spark.createDataFrame([("a_b",), ("axb",), ("a%b",), ("ab",)], "s string")
    assert [r.s for r in I.search(df, wildcard={"s": "a_*"}).collect()] == ["a_b"]
    assert {r.s for r in I.search(df, wildcard={"s": "a?b"}).collect()} == {"a_b", "axb", "a%b"}


def test_merge_overwrites_with_null(spark):
    docs = spark.createDataFrame([(1, "old"), (2, "old")], "doc_id int, llm_response string")
    res = spark.createDataFrame([(1, 5, 1, "first"), (1, 9, 2, None)], "matched_doc int, t int, ask_id int, llm_response string")
    run = lambda policy: {r.doc_id: (r.llm_response, r.llm_matched) for r in I.merge_enrichment(docs, res, fields=("llm_response",), null_policy=policy).collect()}
    assert run("overwrite") == {1: (None, True), 2: ("old", False)}
    assert run("keep") == {1: ("old", True), 2: ("old", False)}


def test_rule_cycle_is_refused(spark):
    rules = (RU.Rule(1, 3, "a", (2,)), RU.Rule(2, 3, "b", (1,)))
    with pytest.raises(ValueError):
        RU.evaluate_rules(spark.range(1), rules)


def test_upstream_parent(spark):
    df = spark.createDataFrame([(1, [533]), (2, [])], "event_id int, before array<int>")
    got = RU.evaluate_rules(df, (RU.Rule(300002, 0, "quiet", (533,)),), fired_before="before").collect()
    assert [(r.event_id, r.rule_id) for r in got] == [(1, 300002)]


def test_classifier_skips_hits(spark):
    def make():
        def predict(texts):
            assert not any("nmap" in t for t in texts)
            return D.keyword_logits()(texts)
        return predict

    df = spark.createDataFrame([("nmap probe",), ("trojan-like flood",), ("plain",)], "text string")
    got = {r.text: r.threat_class for r in D.cascade(df, make_model=make).collect()}
    assert got == {"nmap probe": "port_scan", "trojan-like flood": "malware", "plain": "normal"}


def test_kafka_source_is_gated(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        io.kafka_events(spark, "localhost:1", "topic")


def test_literals_are_necessary(spark):
    """Texts built to match each signature alternative are found with the literal test in front."""
    texts = ["UNION x SELECT", "x OR y = z", "DROP a TABLE", "delete x FROM", "Insert x into", "UPDATE t table", "<ScRipt", "JavaScript:", "OnError=", "onload=", "ALERT(", "eval(",
             "document.COOKIE", ";", "|", "&&", "`", "$(x)", "../", "..\\", "/ETC/passwd", "FAILED password 3 TIMES", "authentication x failed 2 time", "Too Many x Attempts",
             "account is LOCKED", "Virus", "TROJAN", "ransomware", "malware", "infected", "CryptoMiner", "rootkit", "keyLogger", "syn x FLOOD", "port x SCAN", "NMAP", "masscan",
             "path x Traversal", "CMD.EXE", "/bin/BASH", "PowerShell", "PORT ſCAN", "Keylogger", "troİan", "vırus", "plain text"]
    want = []
    for t in texts:
        hit = next((i for i, (_, p) in enumerate(C.SIGNATURES) if re.search(p, t, re.IGNORECASE)), None)
        want.append(None if hit is None else C.SIGNATURES[hit][0])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r.regex_category for r in D.signature_match(df).orderBy("i").collect()]
    assert got == want


def test_streamed_thresholds_of_all_rows_at_once(monkeypatch):
    import numpy as np

    from logvigil.streaming import profile_stream as PS

    rng = np.random.default_rng(1)
    w = rng.choice([0.5, 2.0, 3.25, 1e9, np.inf, np.nan], (300, 40)) * rng.integers(1, 9, (300, 40))
    w[:, 0] = rng.random(300)  # no window is empty
    with np.errstate(invalid="ignore"):
        want = np.nanpercentile(w, 98.0, axis=1)
        monkeypatch.setattr(np, "nanpercentile", None)  # it takes the rows one by one
        got = PS._quantile(np.sort(w, axis=1), (~np.isnan(w)).sum(1), 0.98)
    finite = np.isfinite(want)
    assert finite.any() and (got[finite] == want[finite]).all() and not np.isfinite(got[~finite]).any()
