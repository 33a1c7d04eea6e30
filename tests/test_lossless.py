"""No row is lost, cut or multiplied: late files, null keys, repeated ids, mistyped fields, non-finite values."""

import pytest
from pyspark.sql import functions as F

from logvigil.functions import skew
from logvigil.operators import detect as D
from logvigil.operators import peers as PE
from logvigil.operators import review as R
from logvigil.plans import dfp
from logvigil.sources import io
from logvigil.streaming import gates
from logvigil.streaming.sources import drain


def test_mistyped_fields_keep_their_row(spark):
    rows = ['{"a":"443","b":1}', '{"a":"n/a","b":2}', '{"a":{"x":1},"b":3}', '{"a":null,"b":4}', "{'a':5}", '{"a":', "[1]x", None, '{"b":6,"b":7}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = [tuple(r) for r in io.decode_json(df, "a int, b int").collect()]
    assert got[:4] == [(443, 1), (None, 2), (None, 3), (None, 4)] and len(got) == 5
    assert io.decode_json(df, "a int, b int", on_error="only").count() == 4


def test_nulls_are_written(spark):
    assert io.to_messages(spark.createDataFrame([(1, None)], "a int, b string")).first().value == '{"a":1,"b":null}'


def test_topic_options():
    assert io.kafka_options("h:1", "t", "earliest", "g", 5)["maxOffsetsPerTrigger"] == "5"
    assert "maxOffsetsPerTrigger" not in io.kafka_options("h:1", "t", "earliest", max_offsets=5, batch=True)
    assert io.kafka_options("h:1", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        io.kafka_options("h:1", "t", batch=True)


def test_rows_without_a_group_stay(spark):
    e = spark.createDataFrame([(i, i, [0, 1, None][i % 3], float(i)) for i in range(300)], "event_id long, ts long, group_id int, x double")
    e = e.withColumn("ts", F.timestamp_seconds("ts"))
    out = PE.refresh_peer_stats(e, ["x"], every=50)
    assert out.count() == 300 and out.filter("group_id is null").count() == 100
    last = out.filter("event_id = 299").first()
    assert last.group_avg_x == sum(i for i in range(300) if i % 3 == 2) / 100


def two_files(spark, tmp_path, rows):
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "event_id long, srcip string, t long").withColumn("ts", F.timestamp_seconds("t")).coalesce(1).write.parquet(f"{tmp_path}/in/f{i}")
    s = spark.readStream.schema("event_id long, srcip string, t long, ts timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false")
    return s.parquet(f"{tmp_path}/in")


def test_late_files_come_out_of_the_gates(spark, tmp_path):
    rows = [[(i, "a", 100_000 + i * 400) for i in range(10)], [(100 + i, "a", 1000 + i) for i in range(4)]]
    e = two_files(spark, tmp_path, rows)
    out = drain(gates.cooldown_gate_stream(e, ["srcip"], cooldown=300), "late")
    assert out.count() == 14 and out.filter("gate_pass = 1").count() in (10, 11)
    many = drain(gates.frequency_rule_stream(e, ["srcip"], 1, 120), "late")
    assert many.count() == 14


def test_an_id_is_never_forgotten(spark, tmp_path):
    rows = [[(1, "x", 0), (2, "y", 1)], [(1, "x", 10**8), (3, "z", 10**8)], [(2, "y", 2 * 10**8)]]
    e = two_files(spark, tmp_path, rows).withColumnRenamed("event_id", "doc_id")
    gates.unseen_to(e, f"{tmp_path}/sent", f"{tmp_path}/check", available_now=True).awaitTermination()
    sent = lambda: sorted(r.doc_id for r in gates.sent_ids(spark, f"{tmp_path}/sent", e.schema).read().collect())
    assert sent() == [1, 2, 3]
    for checkpoint in ("check", "another"):  # a restart and a new checkpoint send nothing twice
        gates.unseen_to(e, f"{tmp_path}/sent", f"{tmp_path}/{checkpoint}", available_now=True).awaitTermination()
        assert sent() == [1, 2, 3]


def test_repeated_ids_are_not_multiplied(spark, sf_dir):
    from logvigil.plans.catalog.registry import view

    e = view(spark, sf_dir, "fw")
    twice = e.unionByName(e.filter("event_id < 20"))
    for scorer in ("pca", "zero"):
        assert dfp.score(twice, clock=F.col("ts"), scorer=scorer).count() == twice.count()


def test_peer_score_skips_what_is_not_finite(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, float("nan")), (float("inf"), None), (None, None)], "a double, b double")
    df = df.withColumns({"g_mean_a": F.lit(0.0), "g_std_a": F.lit(1.0), "g_mean_b": F.lit(5.0), "g_std_b": F.lit(1.0)})
    got = [r[0] for r in df.select(PE.peer_score(["a", "b"])).collect()]
    assert got == pytest.approx([1 / 6, 1 / 3, 0.0, 0.0])


def test_values_that_are_no_numbers(spark):
    df = spark.createDataFrame([("n/a", "tcp"), ("443", "6"), (None, None)], "port string, proto string")
    got = [tuple(r) for r in df.select(D.service_name(F.col("port")), D.protocol_name(F.col("proto"))).collect()]
    assert got[0] == ("port n/a", "Protocol tcp") and got[2] == ("port unknown", "Protocol unknown") and got[1][1] != "Protocol 6"


def test_verdict_forms(spark):
    rows = ["{'is_threat': true, 'confidence': 85}", '{"is_threat": true, "confidence": 85, "reason": null}', '{"is_threat": true, "confidence": 85}', """{"is_threat": true, 'confidence': 85}"""]
    df = spark.createDataFrame([(r, 0) for r in rows], "answer string, dfp_is_anomaly int")
    got = [(r.verdict_threat, r.verdict_confidence, r.verdict_reason) for r in D.parse_verdict(df).collect()]
    assert got[1] == (1, 85, None) and got[2] == (1, 85, "No reason provided") and got[3][:2] == (1, 70)


def test_attack_behind_300_characters_is_seen(spark):
    df = spark.createDataFrame([(1, "x" * 400 + " UNION ALL SELECT name FROM users")], "event_id long, full_log string")
    df = df.withColumn("text", D.detection_text(df))
    assert D.signature_match(df, "text").first().regex_match


def test_enrichment_keeps_the_verdict(spark):
    df = spark.createDataFrame([("t", "a", "b", "x", 85, "why", "low", "analyzed")], "`@timestamp` string, srcip string, dstip string, threat_class string, llm_confidence int, llm_response string, llm_trigger string, llm_status string")
    r = R.enrichment_record(df).first()
    assert (r.llm_confidence, r.llm_response, r.llm_trigger) == (85, "why", "low")


def test_hot_null_key_is_split(spark):
    rows = [(i, None if i % 3 else f"k{i % 7}", i // 4) for i in range(900)]
    df = spark.createDataFrame(rows, "event_id long, k string, t long").withColumn("ts", F.timestamp_seconds("t"))
    cold, hot = skew.split_hot(df, ["k"], skew.hot_keys(df, ["k"], 100))
    assert hot.filter("k is null").count() == 600 and cold.filter("k is null").count() == 0
    for limit in (100, 10**6):
        got = sorted(map(tuple, skew.range_counts(df, ["k"], "t", 10, "n", limit).select("event_id", "n").collect()))
        num = sorted(map(tuple, skew.numbered(df, "k", "ts", "event_id", hot_rows=limit).select("event_id", "seq").collect()))
        if limit == 100:
            first = (got, num)
    assert first == (got, num) and len(got) == 900
