"""Plans that must stay as they are: what is pruned, how often data moves, what Python is called with."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logvigil.functions import constants as C
from logvigil.functions.bloom import build_filter
from logvigil.operators import detect as D
from logvigil.operators import index as I
from logvigil.operators import models as MO
from logvigil.operators import rules as R
from logvigil.streaming import profile_stream as PS


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_filter_passes_every_key_and_few_others(spark):
    keys = spark.range(5000).select(F.when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("a"), (F.col("id") % 7).alias("b"))
    near = build_filter(keys, 5000)
    test = near([F.col("a"), F.col("b")])
    assert keys.filter(test).count() == 5000
    others = spark.range(100_000).select(F.concat(F.lit("x"), "id").alias("a"), F.lit(1).cast("bigint").alias("b"))
    assert others.filter(test).count() < 2500
    assert build_filter(keys, 5000, max_bytes=1000) is None
    assert keys.filter(build_filter(keys.limit(0), 0)([F.col("a"), F.col("b")])).count() == 0


def asks_and_docs(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") * 7 % 100_000).alias("t"), F.concat(F.lit("s"), F.col("id") % 997).alias("srcip"),
                                      F.when(F.col("id") % 41 > 0, F.concat(F.lit("d"), F.col("id") % 13)).alias("dstip"), (F.col("id") % 5).alias("srcport"))
    asks = docs.filter("doc_id % 200 = 3").select(F.col("doc_id").alias("ask_id"), (F.col("t") + 250).alias("t"), "srcip", "dstip", F.when(F.col("doc_id") % 400 == 3, F.col("srcport")).alias("srcport"))
    return asks, docs


def test_documents_are_pruned_before_they_move(spark):
    asks, docs = asks_and_docs(spark)
    near = I.near_asks(docs, asks)
    assert exchanges(near) == 0 and 100 <= near.count() < 20_000 * 0.05
    rows = lambda df: sorted(map(str, df.collect()))
    got = I.match_enrichment(asks, docs)
    assert rows(got) == rows(I.match_enrichment(asks, docs, max_bytes=1)) and got.filter("matched_doc is not null").count() == 100
    assert I.match_enrichment(asks.limit(0), docs).count() == 0 and I.match_enrichment(asks, docs.limit(0)).filter("matched_doc is not null").count() == 0


def test_frequency_rules_take_one_pass(spark):
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 50 == 0 else f"s{0 if rng.random() < 0.4 else int(rng.integers(1, 9))}", int(rng.integers(0, 3000)), [[], [1], [2], [1, 2], None][int(rng.integers(0, 5))]) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id long, srcip string, t long, fired_rules array<int>")
    rules = tuple(R.Rule(10 + i, 5 + i, "$(srcip) again", parents, frequency=n, timeframe=s) for i, (parents, n, s) in enumerate(
        [((1,), 3, 120), ((1,), 5, 120), ((2,), 2, 30), ((1, 2), 4, 60), ((9,), 1, 60)]))
    one = R.frequency_rules(df, rules=rules)
    assert exchanges(one) == 1 and exchanges(R.frequency_rules(df, rules=rules[:1])) == 1
    want = []
    for r in rules:
        up = F.arrays_overlap("fired_rules", F.array(*[F.lit(p) for p in r.parents]))
        for x in R.frequency_rule(df, up, r.frequency, r.timeframe).collect():
            want.append((x.event_id, x.matches, r.rule_id, r.level, f"{x.srcip} again"))
    cells = lambda d: sorted(tuple(x) for x in d.select("event_id", "matches", "rule_id", "rule_level", "rule_description").collect())
    assert want and cells(one) == sorted(want)
    assert cells(R.frequency_rules(df, rules=rules, hot_rows=200)) == sorted(want)
    assert R.frequency_rules(df, rules=()).count() == 0


def test_stacked_training_equals_single_training(spark):
    x = np.random.default_rng(2).normal(size=(130, 15, 34))
    stacked = MO._train_autoencoders(x)
    np.testing.assert_allclose(stacked, [MO._train_autoencoder(e) for e in x], rtol=1e-9, atol=1e-12)
    before, MO.EPOCHS = MO.EPOCHS, 0
    try:
        untrained = MO._train_autoencoders(x)
    finally:
        MO.EPOCHS = before
    loss = lambda params: np.mean([((MO._forward(z, MO._unpack(p, 34), np.random.default_rng(0))[0] - z) ** 2).mean() for p, z in zip(params, (x - x.mean(1, keepdims=True)) / x.std(1, keepdims=True))])
    assert loss(stacked) < loss(untrained)


def test_models_of_entities_with_enough_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(e * 100 + i, i, f"e{e}", *map(float, rng.integers(0, 99, 34))) for e in range(150) for i in range(14 if e % 10 == 0 else 17)]
    names = [f for f in C.TRAFFIC_FEATURES]
    df = spark.createDataFrame(rows, "event_id long, ts long, entity string, " + ", ".join(f"{f} double" for f in names))
    got = {r.entity: r.params for r in MO.train_models(df, "autoencoder").collect()}
    assert len(got) == 135 and "e0" not in got
    first = pd.DataFrame(rows, columns=["event_id", "ts", "entity", *names])
    mean = first[first.entity == "e7"].head(15)["sentbyte"].mean()
    assert got["e7"][names.index("sentbyte")] == pytest.approx(mean)


def test_signature_literals_are_necessary(spark):
    """What the patterns match, the literal groups let through."""
    texts = ["x OR 1=1", "union all SELECT", "DROP old TABLE", "syn packet flood", "PORT sweep scan", "nmap", "path a traversal", "failed password 5 times", "authentication has failed 3 time",
             "account is locked", "too many login attempts", "$(id)", "a;b", "clean text", "or nothing", "union only", "account open"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.regex_pattern for r in D.signature_match(df).select("regex_pattern").collect()]
    plain = [r.regex_pattern for r in D.signature_match(df, signatures=list(C.SIGNATURES)).select("regex_pattern").collect()]
    assert got == plain and sum(p is None for p in got) == 4


class Value:
    def __init__(self):
        self.value, self.writes = None, 0

    def get(self):
        return self.value

    def update(self, v):
        self.value, self.writes = v, self.writes + 1

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.values = {}

    def getValueState(self, name, schema, ttlDurationMs=None):
        assert ttlDurationMs
        return self.values.setdefault(name, Value())


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_state_of_a_profile():
    rng = np.random.default_rng(6)
    data = pd.DataFrame({f: rng.integers(0, 50, 300).astype(float) for f in C.TRAFFIC_FEATURES})
    data["ts"], data["event_id"] = np.arange(300), np.arange(300)
    columns = ["event_id", "seq", "port_entropy", "byte_variance", "recon_err", "err_count", "threshold"]

    def run(cuts, block, shuffled=False, step=0):
        handle, out = Handle(), []
        p = PS.ProfileProcessor(columns, "ts", "event_id", 1000, block)
        p.init(handle)
        for i, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 300])):
            part = data.iloc[lo:hi]
            part = part.sample(frac=1, random_state=1) if shuffled else part
            out += list(p.handleInputRows(("e",), iter([part.iloc[:2], part.iloc[2:]]), Clock(i * step)))
        return pd.concat(out, ignore_index=True), handle.values

    whole, _ = run([], 10_000)
    cut, state = run([5, 14, 15, 40, 290], 7, shuffled=True)
    pd.testing.assert_frame_equal(cut, whole, check_exact=False, rtol=1e-12)
    assert state["baseline"].writes == 1 and state["training"].value is None
    assert len(state["rings"].value[1]) == C.RING_ROWS and len(state["errors"].value[0]) == C.ERROR_ROWS
    _, state = run([50, 100, 150, 200, 250], 1000, step=300)  # half of the idle time is 500
    assert 1 < state["baseline"].writes < 6
