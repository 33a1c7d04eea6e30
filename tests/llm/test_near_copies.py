"""The pipeline's near-duplicate stage against brute-force Jaccard over five-word shingles."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from logvigil.llm import near_copies as N


def plain_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(a, b):
    return len(a & b) / len(a | b)


def plain_kept(rows):
    """(id, text) of the smallest id of each component of all pairs at 0.8 or more."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        best.setdefault(find(i), []).append((d is None, d or 0))
    return Counter(min(x) for x in best.values())


def edited(rng, text, n):
    w = text.split()
    for i in rng.sample(range(0, len(w), 6), n):  # at least six words apart
        w[i] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def rows():
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(900)}" for _ in range(300)) for _ in range(14)]
    out = [(100 + i, b) for i, b in enumerate(base)]
    for i, b in enumerate(base):
        out += [(200 + 10 * i + n, edited(rng, b, n)) for n in (1, 2, 4, 5, 6)]  # similarity 0.97 to 0.82
        out += [(500 + 10 * i + n, edited(rng, b, n)) for n in (9, 14, 25)]  # look-alikes, 0.74 and less
    out += [(900 + i, edited(rng, base[0], 6)) for i in range(80)]  # 0.82 to their source only
    return out + [(3, base[1]), (None, base[2]), (None, "unlike any other"), (7, None), (8, ""), (9, " \t"), (20, "one two"), (21, "One  Two"), (22, "two one"), (3, base[1])]


def test_stage_keeps_one_of_each_component(spark):
    table = rows()
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(5)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == plain_kept(table)


def test_shingles_and_signature_of_long_text(monkeypatch):
    text = " ".join(f"w{i % 977} x{i % 31}" for i in range(9_000))
    want = N.signature(text).tolist()
    assert len(N.shingle_set(text)) == len(plain_set(text))
    words = N.word_blocks
    monkeypatch.setattr(N, "word_blocks", lambda data: words(data, 100))
    assert N.signature(text).tolist() == want


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_exact_sets_decide(spark, least):
    texts = [t for _, t in rows()[:60]]
    df = spark.createDataFrame(list(enumerate(texts)), "fp long, text string")
    pairs = [(i, j) for i in range(60) for j in range(i)]
    got = N.similar(spark.createDataFrame(pairs, "u long, v long"), df, least).collect()
    assert {(r.u, r.v) for r in got} == {(i, j) for i, j in pairs if jaccard(plain_set(texts[i]), plain_set(texts[j])) >= least}


def test_covered_fingerprints_are_a_search_of_their_own(spark, monkeypatch):
    """Without bands, the covering still joins all pairs of fingerprints at ``REACH`` bits or fewer, and exact sets decide."""
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(9000)}" for _ in range(1500)) for _ in range(10)]
    texts = base + [edited(rng, b, n) for b in base for n in (1, 2, 3, 40)] + [base[0], None, "", "one two", "ONE two"]
    sets = {int(s[0]): int(s[1]) for s in map(N.signature, texts)}
    near = {frozenset((a, b)) for a in sets for b in sets if a < b and ((sets[a] ^ sets[b]) & (1 << 64) - 1).bit_count() <= N.REACH}
    assert len(near) > 10
    df = spark.createDataFrame(list(sets.items()), "fp long, print long")
    got = [(r.u, r.v) for r in N.covered(df).collect()]
    assert all(u > v for u, v in got)

    def groups(pairs):
        root = {f: f for f in sets}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f

        for a, b in map(tuple, pairs):
            root[find(a)] = find(b)
        return {frozenset(f for f in sets if find(f) == r) for r in set(map(find, sets))}

    linked = groups(got)
    assert all(any(p <= g for g in linked) for p in near)
    none = spark.createDataFrame([], "u long, v long")
    monkeypatch.setattr(N, "candidates", lambda sets: none)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, named = N.components(docs)
    root = {r.fp: r.root for r in named.collect()}
    of = {int(N.signature(t)[0]): plain_set(t) for t in texts}
    want = [p for p in near if jaccard(*(of[f] for f in p)) >= 0.8]
    assert want and all(root[a] == root[b] for a, b in map(tuple, want))
    assert all(max(jaccard(of[a], of[b]) for b in of if b != a and root[b] == root[a]) >= 0.8 for a in of if list(root.values()).count(root[a]) > 1)


@pytest.mark.parametrize("part", [3, 512])
def test_sets_of_one_bucket_are_linked_without_its_first(spark, monkeypatch, part):
    """All sets share the only bucket; most similar pairs are not similar to its smallest set."""
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(9000)}" for _ in range(300)) for _ in range(6)]
    texts = base + [edited(rng, b, n) for b in base for n in (1, 2, 3)]
    monkeypatch.setattr(N, "masks", lambda reach: [0])
    monkeypatch.setattr(N, "candidates", lambda sets: spark.createDataFrame([], "u long, v long"))
    monkeypatch.setattr(N, "PART", part)
    _, named = N.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    root = {r.fp: r.root for r in named.collect()}
    of = {int(N.signature(t)[0]): plain_set(t) for t in texts}
    want = [(a, b) for a in of for b in of if a < b and jaccard(of[a], of[b]) >= 0.8]
    first = min(of)
    assert len({root[a] for a, b in want if first not in (a, b)}) > 3
    assert all(root[a] == root[b] for a, b in want)
    assert len(set(root.values())) >= len(base)


def test_no_exploded_rows_are_broadcast(spark):
    """Spark sizes a bucket's rows like the sets they come from; the keys of many sets would go to every process."""
    sets = spark.range(500).selectExpr("xxhash64(id) as fp", "xxhash64(id, 1) as print", "transform(sequence(1, 24), i -> xxhash64(id, i)) as bands")
    plans = []
    write = N.stored

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, name)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(N, "stored", seen)
        N.covering(sets)
        N.candidates(sets)
    of = dict(reversed(plans))
    assert all("SortMergeJoin" in of[name] and "BroadcastHashJoin" not in of[name] for name in ("covering", "buckets"))
