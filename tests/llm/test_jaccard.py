"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logvigil.llm import jaccard_join as J
from logvigil.llm import common, near_copies, simhash_cover


def plain_set(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def plain(rows):
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)) and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def words(rng, n, size=4000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def edited(rng, base, n):
    w = list(base)
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.randrange(10**7)}"
    return w


def corpus(seed):
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(1, 200)) for _ in range(60)]
    hot = words(rng, 150)
    texts += [edited(rng, hot, rng.randrange(0, 9)) for _ in range(70)]  # one family around the threshold
    for _ in range(6):
        base = words(rng, 90)
        texts += [edited(rng, base, n) for n in (0, 1, 2, 3, 4, 5)]
    passage, other = words(rng, 60), words(rng, 60)
    texts += [words(rng, rng.randrange(5, 60)) + passage for _ in range(40)]  # look-alikes with a common passage
    texts += [passage + other + words(rng, rng.randrange(1, 40)) for _ in range(40)]
    chain = words(rng, 120)
    for _ in range(25):  # neighbours are near, the ends are not
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [["thank", "you", "for", "your", "mail", "mr", f"n{i}", "bye"] for i in range(30)]
    texts += [["thank", "you", "for", "your", "mail", "mr"], ["thank", "you", "for", "your", "mail"], ["thank", "you"], ["Thank", "YOU"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (902, " \t"), (None, rows[3][1]), (None, "alone here"), (None, None), (5, rows[5][1]), (903, "Éa éa"), (904, "éa éa"), (905, "x" * 20_000), (907, "\u00a0"), (908, " \u00a0 "), (906, rows[70][1].upper())]


@pytest.mark.parametrize("seed, size", [(2, 2)])
def test_components(spark, monkeypatch, seed, size):
    monkeypatch.setattr(J, "LIST", size)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, fp string").repartition(4)
    assert sorted(map(tuple, J.components(docs).collect()), key=str) == plain(rows)


def test_shuffled_sides_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST", 0)
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.components(docs).collect()), key=str) == plain(rows)
    assert J.components(docs.limit(0)).count() == 0
    assert J.components(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == [(1, 0, 1)]


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert sorted(map(tuple, J.components(docs).collect()), key=str) == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@settings(max_examples=500, deadline=None)
@given(st.integers(0, 10**9))
def test_similar_sets_share_a_key(seed):
    """Whatever tokens are frequent, sets at the threshold meet in a list."""
    rng = random.Random(seed)
    n = rng.choice([1, 2, 4, 5, 7, 8, 9, 16, 31, 40, 80])
    base = rng.sample(range(10**6), 2 * n)
    x, y = set(base[:n]), set(base[:n])
    while rng.random() < 0.9:
        z = (x, y)[rng.randrange(2)]
        if rng.random() < 0.5 and len(z) > 1:
            z.discard(rng.choice(sorted(z)))
        else:
            z.add(rng.randrange(10**6))
    if 100 * len(x & y) < 80 * len(x | y):
        return
    share = rng.choice([0, 0.3, 0.8, 0.95, 1])
    frequent = np.array(sorted(t for t in x | y if rng.random() < share), np.int64)
    (_, a), (_, b) = (J.keys_of(np.array(sorted(s), np.int64), frequent) for s in (x, y))
    assert len(np.intersect1d(a, b))


def test_keys_stay_in_proportion():
    h = np.sort(np.random.default_rng(2).integers(0, 1 << 48, 5000))
    for frequent in (h[:0], h[::2], h):
        assert len(J.keys_of(h, frequent)[1]) < 2 * len(h)


def test_hot_family_costs_a_row_for_each_set(spark):
    """A large family of near copies meets its hubs, not itself."""
    rng = random.Random(9)
    base = words(rng, 200)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(1, 5)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signed = docs.select(J.F.xxhash64("text").alias("mark"), J.signed("text").alias("s")).select("s.fp", "s.n", "mark", "s.shown")
    keys = J.index(docs, "text", signed)
    listed = J.stored(keys.join(keys.groupBy("key").agg(J.F.count("*").alias("c")).filter("c > 1"), "key"), "listed")
    assert J.hubs(listed).count() < 8 * len(rows) and J.short_pairs(listed).count() < 8 * len(rows)
    assert {r.component_id for r in J.components(docs).collect()} == {0}


def test_whole_set_has_every_shingle():
    text = " ".join(f"w{i % 97} É" for i in range(3000))
    assert len(J.whole_set(text)) == len(plain_set(text)) and len(J.whole_set(" \n")) == 0 and len(near_copies.shingle_set("a b")) == 1


def test_few_stored_steps(spark, monkeypatch):
    """Each stored step costs a file for each partition, however small: links that differences add join components, not sets again."""
    names = []
    keep = lambda df, name: names.append(name) or common.stored(df, name)
    monkeypatch.setattr(J, "stored", keep)
    monkeypatch.setattr(simhash_cover, "stored", keep)
    monkeypatch.setattr(J, "LIST", 2)
    rows = corpus(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, J.components(docs).collect()), key=str) == plain(rows)
    assert "strays" in names and names.count("stars") < 6 and len(names) < 26


def test_stars_need_no_round(spark, monkeypatch):
    rng = random.Random(4)
    for _ in range(3):
        links = {(u, rng.randrange(u)) for u in (rng.randrange(1, 60) for _ in range(40))}
        got = simhash_cover.connected(spark.createDataFrame(sorted(links), "u long, v long")).collect()
        least = list(range(60))
        for _ in range(60):
            for u, v in links:
                least[u] = least[v] = min(least[u], least[v])
        assert sorted(map(tuple, got)) == [(u, v) for u, v in enumerate(least) if u != v]
    monkeypatch.setattr(simhash_cover, "star_round", lambda e: pytest.fail("a round over stars"))
    assert sorted(map(tuple, simhash_cover.connected(spark.createDataFrame(got)).collect())) == sorted(map(tuple, got))
