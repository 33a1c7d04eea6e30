"""SimHash components against all pairs."""

import random

import xxhash

from logvigil.llm import simhash_cover as S


def plain_print(text):
    w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()
    for c in b"\t\n\r\x0b\x0c":
        w = w.replace(bytes([c]), b" ")
    w = [x for x in w.split(b" ") if x]
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints):
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                root[find(a)] = find(b)
    return {f: find(f) for f in root}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta eps Zeta eta".split()) + str(rng.randrange(99)) for _ in range(300)) for _ in range(12)]
    out = list(base) + [None, "", " \t\n", "one", "one two", "one two three", "ONE Two three", "é\x1cü x y", "x " * 5000]
    for b in base:
        for _ in range(6):
            w = b.split()
            w[rng.randrange(len(w))] = "new"
            out.append(" ".join(w))
    return out + base[:3]


def test_components_like_all_pairs(spark):
    ts = texts()
    rows = [(i, t, "c") for i, t in enumerate(ts)] + [(None, ts[0], "c"), (0, ts[0], "c"), (None, "unlike any other text here", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    prints = [plain_print(t) for _, t, _ in rows]
    comp = plain_components(prints)
    least = {}
    for (d, _, _), f in zip(rows, prints):
        c = comp[f]
        least[c] = min([x for x in (least.get(c), d) if x is not None], default=None)
    want = sorted((str(d), f"{f:016x}", least[comp[f]]) for (d, _, _), f in zip(rows, prints))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.components(docs).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [str(g[2]) for g in got] == [str(w[2]) for w in want]
    kept = S.dedup(docs)
    assert kept.columns == docs.columns
    rows_kept = kept.collect()
    assert len(rows_kept) == len(least)
    assert {str(r.doc_id) for r in rows_kept} == {str(v) for v in least.values()}
    assert S.components(docs.limit(0)).count() == 0 and S.dedup(docs.limit(0)).count() == 0


def test_masks_cover_every_near_pair():
    kept = S.masks()
    assert all(any(not (m >> i & 1 or m >> j & 1) for m in kept) for i in range(64) for j in range(64))


def test_links_of_dense_prints(spark):
    """Chains, hubs and a bucket of many neighbours: exactly the components of all pairs."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for start in list(prints)[:4]:
        f = start
        for _ in range(150):
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(f)
    core = rng.getrandbits(64)
    prints |= {core ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(300)}
    df = spark.createDataFrame([(signed(f),) for f in prints], "fp long")
    roots = {r.u: r.v for r in S.connected(S.links(df)).collect()}
    got = {}
    for f in prints:
        got.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
    want = {}
    for f, c in plain_components(prints).items():
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    whole = S.simhash(text)
    words = S.word_blocks
    monkeypatch.setattr(S, "word_blocks", lambda data: words(data, 100))
    assert S.simhash(text) == whole == signed(plain_print(text))
