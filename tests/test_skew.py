"""Split routes for hot keys give the same rows as the plain ones; a third of all rows on one key."""

import random

import pytest
from pyspark.sql import functions as F

from logvigil.functions import skew
from logvigil.operators import index as I
from logvigil.operators import profile as PR
from logvigil.operators import review as R
from logvigil.operators import rules as RU
from logvigil.plans import dfp
from logvigil.plans.catalog.profile import portable_groups
from logvigil.plans.views import view


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def fw(spark, sf_dir):
    """Firewall events with a third of the rows moved to one source address."""
    e = view(spark, sf_dir, "fw")
    return e.withColumn("srcip", F.when(F.col("event_id") % 3 == 0, "10.0.0.1").otherwise(F.col("srcip"))).cache()


@pytest.fixture(scope="module")
def fw_t(spark, sf_dir):
    e = view(spark, sf_dir, "fw_t")
    # a dense clock, with ties, so that chains are long
    return e.withColumn("srcip", F.when(F.col("event_id") % 3 == 0, "10.0.0.1").otherwise(F.col("srcip"))).withColumn("t", F.expr("t div 40")).cache()


def test_sequence(fw):
    e = fw.withColumnRenamed("srcip", "entity").select("event_id", "ts", "entity")
    assert rows(skew.numbered(e, "entity", "ts", "event_id", hot_rows=20), "event_id", "seq") == rows(skew.numbered(e, "entity", "ts", "event_id"), "event_id", "seq")


def test_sequence_without_key_and_with_equal_times(fw):
    e = fw.select("event_id", F.date_trunc("day", "ts").alias("ts"))
    got = {r.event_id: r.seq for r in skew.sequenced(e, [], "ts", "event_id").collect()}
    order = sorted(((r.ts, r.event_id) for r in e.collect()))
    assert got == {i: n + 1 for n, (_, i) in enumerate(order)}


@pytest.mark.parametrize("hot_rows", [45, 130])
def test_rolling_windows(fw, hot_rows):
    e = dfp.prepare(fw, clock=F.col("ts")).select("event_id", "ts", "entity", "dstport", "total_bytes").cache()
    build = PR.add_rings
    plain = skew.rolling(e, "entity", "ts", "event_id", 19, build).withColumn("byte_variance", F.round("byte_variance", 3)).withColumn("port_entropy", F.round("port_entropy", 9))
    split = skew.rolling(e, "entity", "ts", "event_id", 19, build, hot_rows=hot_rows).withColumn("byte_variance", F.round("byte_variance", 3)).withColumn("port_entropy", F.round("port_entropy", 9))
    cols = ("event_id", "seq", "byte_variance", "port_entropy")
    assert rows(plain, *cols) == rows(split, *cols)


@pytest.mark.parametrize("peers", [False, True])
def test_score(fw, peers):
    groups = portable_groups(fw.withColumnRenamed("srcip", "entity")) if peers else None
    r = lambda df: rows(df.select("event_id", "seq", "dfp_is_anomaly", F.round("dfp_score", 6).alias("s"), F.round("dfp_peer_score", 6).alias("p"), "dfp_status", "dfp_detection_method"), "*")
    plain = r(dfp.score(fw, clock=F.col("ts"), assignments=groups))
    split = r(dfp.score(fw, clock=F.col("ts"), assignments=groups, hot_rows=130))
    assert plain == split and len(plain) == fw.count()


def test_model_score_split(fw):
    r = lambda df: rows(df.select("event_id", "dfp_is_anomaly", F.round("dfp_score", 6).alias("s")), "*")
    assert r(dfp.score(fw, clock=F.col("ts"), scorer="pca")) == r(dfp.score(fw, clock=F.col("ts"), scorer="pca", hot_rows=130))


def test_range_counts(fw_t):
    plain = skew.range_counts(fw_t, ["srcip"], "t", 5, "n")
    split = skew.range_counts(fw_t, ["srcip"], "t", 5, "n", hot_rows=20)
    assert rows(plain, "event_id", "n") == rows(split, "event_id", "n")
    hits = [(r.event_id, r.srcip, r.t) for r in fw_t.collect()]
    want = sorted((i, sum(1 for _, s2, t2 in hits if s2 == s and t - 5 <= t2 <= t)) for i, s, t in hits)
    assert sorted(map(tuple, plain.select("event_id", "n").collect())) == want


def brute_gate(data, cooldown):
    last, out = {}, {}
    for t, i, k in sorted(data):
        ok = k not in last or t - last[k] >= cooldown
        if ok:
            last[k] = t
        out[i] = int(ok)
    return out


@pytest.mark.parametrize("cooldown,long_chain", [(3, 50_000), (3, 1), (7, 10), (20, 1), (600, 1)])
def test_cooldown_gate(fw_t, cooldown, long_chain):
    got = {r.event_id: r.gate_pass for r in R.cooldown_gate(fw_t, ["srcip"], cooldown=cooldown, long_chain=long_chain).collect()}
    assert got == brute_gate([(r.t, r.event_id, r.srcip) for r in fw_t.collect()], cooldown)


def test_cooldown_blocks_on_random_times(spark):
    random.seed(5)
    data = [(i, random.choice("ab"), random.randint(-300, 6000)) for i in range(3000)] + [(5000 + i, "c", t) for i, t in enumerate((0, 3, 5, 8, 400, 2000))]
    e = spark.createDataFrame(data, "event_id bigint, srcip string, t bigint")
    for cooldown in (2, 5):
        got = {r.event_id: r.gate_pass for r in R.cooldown_gate(e, ["srcip"], cooldown=cooldown, long_chain=1).collect()}
        assert got == brute_gate([(t, i, k) for i, k, t in data], cooldown)


def test_match_enrichment(spark):
    random.seed(7)
    pick = lambda: ("a" if random.random() < 0.4 else random.choice("bcd"), random.choice("xy"))
    docs = [(i, *pick(), random.randint(1, 3), random.randint(1, 2), random.randint(-900, 4000)) for i in range(500)]
    asks = [(i, *pick(), random.choice([None, 1, 2, 3]), random.choice([None, 1, 2]), random.randint(-900, 4000)) for i in range(400)]
    cols = "srcip string, dstip string, srcport int, dstport int, t bigint"
    got = I.match_enrichment(spark.createDataFrame(asks, "ask_id bigint, " + cols), spark.createDataFrame(docs, "doc_id bigint, " + cols), seconds=60)
    want = []
    for i, s, d, sp, dp, t in asks:
        hits = [(t2, j) for j, s2, d2, sp2, dp2, t2 in docs if (s2, d2) == (s, d) and abs(t2 - t) <= 60 and sp in (None, sp2) and dp in (None, dp2)]
        want.append((i, min(hits)[1] if hits else None))
    assert sorted((r.ask_id, r.matched_doc) for r in got.collect()) == want


def test_dedup_limits_before_the_shuffle(fw):
    e = fw.select(F.when(F.col("event_id") >= 0, "same").alias("doc_id"), "ts", "event_id")
    d = I.dedup_documents(e)
    assert [r.event_id for r in d.collect()] == [e.orderBy(F.desc("ts"), F.desc("event_id")).first().event_id]
    assert "WindowGroupLimit" in d._jdf.queryExecution().executedPlan().toString()


def test_rate_cap(spark):
    e = spark.createDataFrame([(i, f"2024-01-01 0{i % 3}:00:00") for i in range(400)], "event_id int, s string").select("event_id", F.col("s").cast("timestamp").alias("ts"))
    got = RU.rate_cap(e).collect()
    assert len(got) == 400 and sum(r.deferred for r in got) == 400 - 150
    assert max(r.event_id for r in got if not r.deferred and r.event_id % 3 == 0) == 147


def test_sequence_keeps_rows_without_a_time(fw):
    e = fw.select("event_id", F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("ts"), F.lit("x").alias("entity"))
    assert rows(skew.numbered(e, "entity", "ts", "event_id", hot_rows=20), "event_id", "seq") == rows(skew.numbered(e, "entity", "ts", "event_id"), "event_id", "seq")


def test_running_totals_across_blocks(spark):
    e = spark.createDataFrame([("a", p, p * p) for p in range(-7, 30, 2)] + [("b", 3, 5)], "k string, p bigint, v bigint")
    got = {(r.k, r.p): r.v_before for r in skew.running_totals(e, ["k"], "p", ["v"], block=4).collect()}
    assert got == {**{("a", p): sum(q * q for q in range(-7, p, 2)) for p in range(-7, 30, 2)}, ("b", 3): 0}


@pytest.mark.parametrize("n", [1, 2, 3, 60, 2001, 9000])
def test_exact_percentile(spark, n):
    import numpy as np

    from logvigil.functions.quantiles import exact_percentile

    rng = np.random.default_rng(n)
    values = {"flat": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float), "few": (rng.random(n) < 0.05).astype(float)}
    e = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double")
    for p in (0.95, 0.5, 1.0, 0.0):
        got = {r.k: r.q for r in exact_percentile(e, ["k"], "v", p, "q").collect()}
        assert got == pytest.approx({k: float(np.percentile(vs, p * 100)) for k, vs in values.items()})


def test_training_cap(spark):
    from logvigil.operators import metrics as M

    e = spark.createDataFrame([(i, ("normal", "a", "b", None)[i % 4]) for i in range(4000)], "id bigint, label string")
    got = M.prepare_training_set(e, cap=300).collect()
    sizes = {}
    for r in got:
        sizes[r.label] = sizes.get(r.label, 0) + 1
    assert sizes == {"normal": 1000, "a": 300, "b": 300, None: 300}
    import hashlib

    want = sorted((i for i in range(4000) if i % 4 == 1), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:300]
    assert {r.id for r in got if r.label == "a"} == set(want)
