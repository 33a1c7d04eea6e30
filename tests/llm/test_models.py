"""Learned operators: held-out accuracy, exact parts against plain Python, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logvigil.llm import lang_mixture as L
from logvigil.llm import lm_bloom as B
from logvigil.llm import pu_quality as P
from logvigil.llm import vptree as V
from logvigil.llm.common import table

SF = "/root/testdata/sf0.01"
ODD = [(9001, None), (9002, ""), (9003, "123 !!!"), (None, "Hello there"), (9005, "word " * 60_000), (9005, "word " * 60_000), (9006, "Ünï ñandú été")]


def crc(x, n):
    return zlib.crc32(("" if x is None else str(x)).encode()) % n


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = P.scores(docs, labels)
    rows = got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "quality").toPandas()
    good, bad = rows[rows.quality == 1].score.to_numpy(), rows[rows.quality == 0].score.to_numpy()
    auc = np.mean(good[:, None] > bad[None, :]) + np.mean(good[:, None] == bad[None, :]) / 2
    assert auc > 0.9 and (rows.predicted == rows.quality).mean() > 0.9
    assert {r.doc_id for r in got.filter("held_out").collect()} == {r.doc_id for r in docs.collect() if crc(r.doc_id, 5) == 0}


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(d, t, 3) for d, t in ODD], "doc_id long, text string, x int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = P.scores(docs, none).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    some = spark.createDataFrame([(9002, 1), (9003, 0), (9003, 1), (9006, None), (None, 1)], "doc_id long, quality int")
    assert P.scores(docs, some).count() == len(ODD)
    kept = P.keep_good(docs, some)
    assert kept.columns == docs.columns and P.keep_good(docs.limit(0), some).count() == 0
    assert P.scores(docs.limit(0), none).count() == 0


def test_quality_risk_falls(spark):
    """The fitted risk is below that of the constant model, and negatives' risk is not below zero by much."""
    rng = np.random.default_rng(0)
    positive = rng.random(4000) < 0.7
    x = rng.normal(size=(4000, P.WIDTH)).astype(np.float32) + np.where(positive, 1.0, -1.0)[:, None].astype(np.float32) * 0.3
    known = positive & (rng.random(4000) < 0.5)
    rows = spark.createDataFrame([(list(map(float, r)), bool(k)) for r, k in zip(x, known)], "x array<float>, positive boolean")
    model = P.fit(rows, 0.7)
    assert ((model.scores(x) > 0.5) == positive).mean() > 0.9

    def risk(m, w):
        """The non-negative unbiased risk in plain NumPy, and its risk of negatives."""
        g = P.expand(x, m.mean, m.scale) @ w
        negatives = np.logaddexp(0, g).mean() - m.prior * np.logaddexp(0, g[known]).mean()
        return m.prior * np.logaddexp(0, -g[known]).mean() + max(0.0, negatives) + 1e-3 / 2 * w[:-1] @ w[:-1], negatives

    constant = np.append(np.zeros(3 * P.WIDTH), np.log(0.7 / 0.3))
    least, negatives = risk(model, model.weights)
    assert least < risk(model, constant)[0] - 0.1 and negatives > -0.1  # -0.076: the solver may stop inside the clipped region
    # Newton steps with the reversed gradient below zero stop near the minimum, not at it: neighbours are better by up to 0.0012 here
    for _ in range(50):
        assert risk(model, model.weights + 0.02 * rng.normal(size=len(constant)))[0] > least - 5e-3


@pytest.mark.xfail(strict=True, reason="with a prior far too large the risk of negatives ends at -1.3: below zero the first term still leads the steps")
def test_quality_bound_holds_with_a_wrong_prior(spark):
    rng = np.random.default_rng(0)
    positive = rng.random(4000) < 0.7
    x = rng.normal(size=(4000, P.WIDTH)).astype(np.float32) + np.where(positive, 0.3, -0.3)[:, None].astype(np.float32)
    known = positive & (rng.random(4000) < 0.5)
    m = P.fit(spark.createDataFrame([(list(map(float, r)), bool(k)) for r, k in zip(x, known)], "x array<float>, positive boolean"), 0.97)
    g = P.expand(x, m.mean, m.scale) @ m.weights
    assert np.logaddexp(0, g).mean() - m.prior * np.logaddexp(0, g[known]).mean() > -0.1


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    rows = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    rows = rows[rows.lang_pred != "und"]
    assert (rows.lang_pred == rows.lang).mean() > 0.97


def test_language_mixture_and_edge_cases(spark):
    docs = table(spark, SF, "documents")
    langs, logs = L.train(docs)
    by = {r.lang: r.text for r in docs.filter("length(text) > 3000").groupBy("lang").agg(F.max("text").alias("text")).collect()}
    theta, chosen = L.mixtures([by["en"][:2000] + " " + by["fr"][:1000], by["de"][:2000]], logs)
    assert set(np.flatnonzero(chosen[:, 0])) >= {langs.index("en"), langs.index("fr")} and 0.5 < theta[langs.index("en"), 0] < 0.85
    assert list(np.flatnonzero(chosen[:, 1])) == [langs.index("de")]
    odd = spark.createDataFrame([(d, t, "en", 1.0) for d, t in ODD], "doc_id long, text string, lang string, score double")
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.identify(odd).collect()]
    assert len(got) == len(ODD) and all((p == "und") == (d in (9001, 9002, 9003)) and 0 <= s <= 1 for d, p, s in got)
    unknown = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unknown).collect()} == {"und"}
    assert L.identify(odd.limit(0)).count() == 0


def test_language_sets_have_no_cap():
    """Five languages in one text are all found; a text's answer does not depend on the others of its batch."""
    rng = np.random.default_rng(8)
    letters = [rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:9] for _ in range(7)]
    say = lambda k, n: " ".join("".join(rng.choice(letters[k], 5)) for _ in range(n))
    logs = np.full((7, L.CELLS), 0.5)
    for k in range(7):
        cells, counts = L.counted(say(k, 6000))
        logs[k, cells] += counts
    logs = np.log(logs / logs.sum(1, keepdims=True)).astype(np.float32)
    texts = [" ".join(say(k, 300) for k in range(5)), say(6, 200), say(2, 100) + " " + say(3, 300), "x", " ".join(say(k, 300) for k in range(7))]
    theta, chosen = L.mixtures(texts, logs)
    assert [list(np.flatnonzero(chosen[:, i])) for i in (0, 1, 2, 4)] == [[0, 1, 2, 3, 4], [6], [2, 3], [0, 1, 2, 3, 4, 5, 6]]
    assert abs(theta[:5, 0] - 0.2).max() < 0.03
    for i, t in enumerate(texts):
        alone, one = L.mixtures([t], logs)
        assert (one[:, 0] == chosen[:, i]).all() and abs(alone[:, 0] - theta[:, i]).max() < 1e-3


def plain_base(docs):
    tokens = [(d, [w for w in (t or "").encode().lower().split()] + [None]) for d, t in docs]
    c = Counter(w for d, ws in tokens if crc(d, 10) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(str(d), crc(d, 10) == 0, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for d, ws in tokens]


def check_scores(spark, docs, **how):
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, score int")
    got = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in B.scores(df, **how).collect()), key=str)
    want = sorted(plain_base(docs), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(g[6]) and g[6] < 1e-9 for g in got)
    return got


def test_lm_base_is_exact(spark, monkeypatch):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["the", "of", "rare%d" % rng.randrange(500), "And", "and"]) for _ in range(rng.randrange(80)))) for i in range(300)] + ODD
    whole = check_scores(spark, docs)
    monkeypatch.setattr(B, "BLOCK", 3000)
    monkeypatch.setattr(B, "BUCKET", 300)
    small = check_scores(spark, docs)
    passes = check_scores(spark, docs, max_bytes=1500)
    assert np.allclose([g[6] for g in small], [g[6] for g in passes])
    assert abs(sum(g[6] for g in whole) / sum(g[6] for g in small) - 1) < 0.02
    assert B.scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check_scores(spark, [(d, t) for d, t in docs if crc(d, 10) == 0])


def test_lm_probabilities_sum_to_one_at_most(spark, monkeypatch):
    """Over the whole vocabulary and all contexts, rare ones too; beside the same model from plain counts."""
    rng = np.random.default_rng(5)
    draw = np.minimum(rng.zipf(1.3, 30_000), 900)
    docs = [(i, " ".join(f"w{x}" for x in draw[i * 30:(i + 1) * 30])) for i in range(1000)]
    monkeypatch.setattr(B, "BLOCK", 20_000)
    monkeypatch.setattr(B, "BUCKET", 2000)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = B.fit(df)
    words, pairs = Counter(), Counter()
    for d, t in docs:
        if crc(d, 10):
            ws = t.encode().split() + [b""]
            words.update(ws)
            pairs.update(zip([b"", *ws], ws))
    assert (model.tokens, model.distinct) == (sum(words.values()), len(words)) and len(pairs) > 5000
    known, shape = sorted(words), model.shape
    h, c, f = B.word_hashes(known), np.array([words[w] for w in known]), model.filter()
    left = lambda n: model.left[shape.context_level(n)]
    sums, false = [], 0
    for u, x, n in zip(known, h, c):
        true = np.array([pairs[u, w] for w in known])
        got = shape.least(f.levels(B.pair_hashes(np.full(len(h), x), h)))
        assert (got >= shape.least(shape.level(np.maximum(true, 1))) * (true > 0)).all()
        false += ((got > 0) & (true == 0)).sum()
        sums.append(B.probabilities(got, n, c, left(n), model.norm).sum())
    sums = np.array(sums)
    assert sums.mean() <= 1 and (sums <= 1).mean() > 0.9 and false <= 2 * B.FALSE * len(known)
    assert sums[c == 1].mean() <= 1.01 and sums.min() > 0.6
    at = dict(zip(known, c))
    for r in B.scores(df).filter("held_out").collect():
        ws = docs[r.doc_id][1].encode().split() + [b""]
        want = 0.0
        for u, w in zip([b"", *ws], ws):
            n, m = at.get(u, 0), pairs[u, w]
            want += math.log10(B.probabilities(shape.least(shape.level(np.array([max(m, 1)]))) * (m > 0), n, at.get(w, 0), left(np.array(n)), model.norm)[0])
        assert abs(r.score - want) < 1.5  # of about -90: false levels


def test_lm_predicts_held_out(spark):
    rows = B.scores(table(spark, SF, "documents")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_filter_gives_quantised_counts_back():
    shape = B.Shape()
    h = B.mixed(np.arange(20_000, dtype=np.uint64))
    counts = np.random.default_rng(0).geometric(0.02, 10_000)
    f = B.Filter([(0, shape.part(B.keys(h[:10_000], 0), counts))], 0, shape)
    got = f.levels(h)
    assert (got[:10_000] >= shape.level(counts)).all() and (got[:10_000] == shape.level(counts)).mean() > 0.97
    assert (got[10_000:] > 0).mean() < 0.03
    mid = shape.count(shape.level(np.arange(1, 2000)))
    assert np.abs(mid / np.arange(1, 2000) - 1).max() < 0.3


def brute(vectors, k):
    ids = [i for i, _ in vectors]
    x = np.array([v for _, v in vectors])
    out = set()
    for i, v in vectors:
        if i % 20 == 0:
            s = [((x[j] * np.array(v)).sum(), ids[j]) for j in range(len(ids)) if ids[j] != i]
            out |= {(i, r + 1, j) for r, (_, j) in enumerate(sorted(s, key=lambda t: (-t[0], t[1]))[:k])}
    return out


def test_vptree_exact_with_factor_one(spark):
    rng = np.random.default_rng(2)
    good = [(i, list(map(float, np.float32(rng.normal(size=8) * rng.random() * 3)))) for i in range(900)]
    good += [(i, good[3][1]) for i in range(900, 1100)]  # many ties
    bad = [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] + [1.0] * 7), (2080, [float("inf")] * 8), (None, good[0][1]), (2100, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in good + bad + good[:5]], "vec_id long, embedding array<float>, rank int")
    q = df.filter("vec_id % 20 = 0")
    want = brute(good, 20)
    for shard_rows in (5000, 150):
        got = V.search(df, q, relax=1.0, shard_rows=shard_rows, block_rows=40)
        assert {(r.query_id, r["rank"], r.vec_id) for r in got.collect()} == want
    assert V.search(df.limit(0), q.limit(0)).count() == 0
    few = df.filter("vec_id < 3")
    assert V.search(few, few).count() == 6


def test_vptree_recall(spark):
    df = table(spark, SF, "embeddings")
    got = {(r.query_id, r.vec_id) for r in V.search(df, df.filter("vec_id % 20 = 0")).collect()}
    want = {(q, v) for q, _, v in brute([(r.vec_id, r.embedding) for r in df.collect()], 20)}
    assert len(got & want) >= 0.9 * len(want)


def test_lm_knows_pairs_seen_once(spark):
    """A held-out text of a pair that training has once scores better than one of the same words in an unseen order."""
    train = [i for i in range(400) if crc(i, 10)]
    held = [i for i in range(400) if not crc(i, 10)][:2]
    docs = [(i, f"a{i} b{i}") for i in train] + [(held[0], f"a{train[0]} b{train[0]}"), (held[1], f"a{train[0]} b{train[1]}")]
    got = {r.doc_id: r.score for r in B.scores(spark.createDataFrame(docs, "doc_id long, text string")).filter("held_out").collect()}
    assert got[held[0]] > got[held[1]] + 0.5


def test_ids_with_several_vectors(spark):
    """25 vectors under one query id, ids of several vectors among the candidates: 20 distinct ids, as by brute force."""
    rng = np.random.default_rng(11)
    rows = [(0, list(map(float, rng.normal(size=6)))) for _ in range(25)] + [(1 + i // 3, list(map(float, rng.normal(size=6)))) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = df.filter("vec_id % 100 = 0")
    want = {}
    for a, x in rows:
        for b, y in rows:
            if a % 100 == 0 and a != b:
                want[a, b] = max(want.get((a, b), -9e9), sum(s * t for s, t in zip(x, y)))
    for shard_rows in (16_384, 100):
        got = {}
        for r in V.search(df, q, relax=1.0, shard_rows=shard_rows).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert set(got) == {a for a, _ in want}
        for a, found in got.items():
            best = sorted(((s, -b) for (c, b), s in want.items() if c == a), reverse=True)[:20]
            assert [(i, b) for i, b, _ in sorted(found)] == [(i + 1, -b) for i, (_, b) in enumerate(best)]
            np.testing.assert_allclose([s for _, _, s in sorted(found)], [s for s, _ in best])


def test_lm_blocks_pack_and_probes_are_few():
    """Tokens are numbered by frequency, which packs better than by hash; few probes cost few bits, and keep the share of false ones."""
    rng = np.random.default_rng(4)
    words = [b"w%d" % x for x in np.minimum(rng.zipf(1.2, 60_000), 20_000)]
    block = B._Block()
    block.add(1, False, b" ".join(words).decode())
    row = block.row(0, pa.int64())
    got = B.unpack(row.column("words")[0].as_py()).split(b"\n")
    counts = Counter([*words, b""])
    assert got == sorted(counts, key=lambda w: (-counts[w], w))
    tokens = B.from_planes(row.column("tokens")[0].as_py(), 4, "<i4")
    assert [got[i] for i in tokens] == [*words, b""]
    place = np.empty(len(got), "<i4")
    place[np.argsort(B.word_hashes(got))] = np.arange(len(got))
    assert len(row.column("tokens")[0].as_py()) < 0.85 * len(B.planes(place[tokens], 4))
    shape, need = B.Shape().for_words(300_000), math.log2(300_000 / B.FALSE)
    assert shape.first_probes < 0.75 * need and shape.first_bits < 1.1 * need / math.log(2)
    false = (1 - math.exp(-shape.first_probes / shape.first_bits)) ** shape.first_probes
    assert 300_000 * false <= B.FALSE * 1.01
