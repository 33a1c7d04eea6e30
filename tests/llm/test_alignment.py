"""Tokenizer alignment against a plain version that encodes whole texts with the files' own libraries."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logvigil.llm import token_alignment as T

A, B = f"{T.FOLDER}/{T.FIRST}", f"{T.FOLDER}/{T.SECOND}"


@pytest.fixture(scope="module")
def v():
    with open(A, "rb") as a, open(B, "rb") as b:
        out = T.Vocabularies(a.read(), b.read())
    with open(A, "rb") as a:
        out.own = T.Vocabularies.library(a.read())
    return out


def plain(v, text, by="overlap"):
    """n_a, n_b, n_groups, pairs of links, group text."""
    if not text:
        return 0, 0, 0, [], ""
    data = (" " + text).encode()
    a, b = v.own(" " + text), v.b.encode(text)
    if not b"".join(v.a_bytes[i] for i in a) == data == b"".join(v.b_bytes[i] for i in b):
        return 0, 0, 0, [], ""

    def ranges(ids, table):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i])))
            at += len(table[i])
        return out

    ra, rb = ranges(a, v.a_bytes), ranges(b, v.b_bytes)
    ends = sorted({e for _, e in ra} & {e for _, e in rb})
    group = {}
    for e in range(len(ends)):
        for x in range(ends[e - 1] if e else 0, ends[e]):
            group[x] = e
    ga, gb = [[] for _ in ends], [[] for _ in ends]
    for i, (s, _) in zip(a, ra):
        ga[group[s]].append(i)
    for i, (s, _) in zip(b, rb):
        gb[group[s]].append(i)
    if by == "group":
        pairs = [(x, y) for p, q in zip(ga, gb) for x in p for y in q]
    else:
        pairs = [(x, y) for x, (s, e) in zip(a, ra) for y, (s2, e2) in zip(b, rb) if s < e2 and s2 < e]
    return len(a), len(b), len(ends), pairs, ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in zip(ga, gb))


def expected(v, rows, by="overlap"):
    out = [(d, *plain(v, t, by)) for d, t in rows]
    count = Counter(p for r in out for p in r[4])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(top.get(y, 0), n)
    return sorted(((d, na, nb, ng, len(p), sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p), hashlib.sha256(g.encode()).hexdigest() if na else "") for d, na, nb, ng, p, g in out), key=str)


rng = random.Random(12)
WORDS = ["the", "Straße", "naïve", "漢字仮名", "🙂🙃", "don't", "x_1=23;", "ofanwhwhst", "thingtionnt.\nNew", "été", "\tindent", "a b"]
ROWS = [(i, " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", " "]) for _ in range(rng.randrange(60)))) for i in range(50)] + [
    (100, None), (101, ""), (102, " "), (103, "  two  spaces  "), (104, "piece ▁ mark"), (105, "<|endoftext|> </s> <unk> <0x41>"), (None, "no id"), (7, "the same"), (7, "the same"), (106, "x" * 900), (107, "a ")]


def test_numbers_and_groups(spark, v):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in ROWS], "doc_id long, text string, n_a int, groups string").repartition(3)
    assert sorted(map(tuple, T.report(docs).collect()), key=str) == expected(v, ROWS)
    assert T.report(docs.limit(0)).count() == 0


def test_rare_pairs_by_join(spark, v):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    for limit in (0, 40):
        assert sorted(map(tuple, T.align(docs, limit=limit).collect()), key=str) == expected(v, ROWS)


def test_shared_groups_and_their_texts(spark, v):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = T.align(docs, links="group", groups=True).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == expected(v, ROWS, "group")
    assert sorted(r.groups for r in got) == sorted(plain(v, t)[4] for _, t in ROWS)


def test_long_texts_in_pieces(v, monkeypatch):
    text = " ".join(t for _, t in ROWS if t and "▁" not in t)
    own = T.Aligner(v)
    want = plain(v, text)
    whole = own.measure([text])
    monkeypatch.setattr(T, "BATCH", 100)
    assert len(list(T.pieces(text))) > 20 and " ".join(T.pieces(text)) == text
    numbers, written, digest, key, times = T._long(own, text)
    assert numbers.tolist() == whole.numbers[0].tolist() == [*want[:3], len(want[3])]
    assert written == whole.written[0] == want[4].encode() and digest == hashlib.sha256(written).hexdigest()
    assert dict(zip(key.tolist(), times.tolist())) == Counter(x * len(v.b_bytes) + y for x, y in want[3])
    assert T._long(own, text + " ▁ " + text) is None


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t　 \u0085\x1c\x00ab.'sé漢🙂<|>1​▁", max_size=60))
def test_any_text(v, text):
    m = T.Aligner.__new__(T.Aligner)
    m.__dict__.update(test_any_text.own.__dict__ if hasattr(test_any_text, "own") else T.Aligner(v).__dict__)
    test_any_text.own = m
    if text:
        got, want = m.measure([text]), plain(v, text)
        assert (*got.numbers[0].tolist(), got.written[0].decode()) == (*want[:3], len(want[3]), want[4])


def test_rank_encoder_over_all_code_points(v):
    for lo in range(0, sys.maxunicode + 1, 4096):
        text = "".join(f" {c}a{c}{c}1 {c}." for c in map(chr, range(lo, lo + 4096)) if not "\ud800" <= c <= "\udfff")
        assert v.first(text) == v.own(text), hex(lo)


def test_product_is_a_matrix_product():
    g = np.random.default_rng(1)
    for block in (1, 7, 1 << 20):
        x, y = (g.integers(0, 3, s) * (g.random(s) < 0.3) for s in ((9, 14), (14, 11)))

        def csr(m):
            r, c = np.nonzero(m)
            return T.Csr(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(m)))]), c, m[r, c], m.shape[1])

        out = T.product(csr(x), csr(y), block)
        dense = np.zeros((9, 11), int)
        dense[out.row_of(), out.idx] = out.val
        assert (dense == x @ y).all()
        assert (np.diff(csr(y).transposed().ptr) == (y != 0).sum(0)).all()
