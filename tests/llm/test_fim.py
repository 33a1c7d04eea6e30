"""Fill-in-middle against a plain version by regular expression."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logvigil.llm import fim_chunks as M

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    w = TOKEN.findall(text)
    d = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(w), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(text, known):
    t = M.Text(text.encode("utf-8", "surrogatepass"), known)
    w = TOKEN.findall(text)
    assert t.tokens == len(w)
    at = 0
    for k in range(len(w) + 1):
        assert t.cut(k) == at
        at += len(w[k]) if k < len(w) else 0


@pytest.fixture
def tiny(monkeypatch):
    """Chunks of a few bytes, so that borders fall inside words and characters."""
    for name, value in (("LEAST", 1), ("MOST", 7), ("BORDER", 2), ("BLOCK", 16)):
        monkeypatch.setattr(M, name, value)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x85 aé漢🙂.", max_size=120))
def test_cuts_of_any_text(text):
    check(text, M.Chunks())


def test_cuts_with_tiny_chunks(tiny):
    rng, known = random.Random(3), M.Chunks(2000)
    for _ in range(300):
        check("".join(rng.choice("  \nabé漢🙂") for _ in range(rng.randrange(90))), known)
    check("x" * 200 + " " * 100 + "é" * 50 + "\t", known)


def test_chunks_follow_content_and_are_remembered():
    rng = random.Random(5)
    body = " ".join(f"w{rng.randrange(5000)}" for _ in range(20_000)).encode()
    known = M.Chunks()
    M.Text(body, known)
    n = len(known)
    M.Text(b"another beginning " + body, known)
    assert n > 50 and len(known) <= n + 3  # only chunks near the change are new
    sizes = [b - a for a, b in zip([0, *M.borders(body)], M.borders(body))]
    assert max(sizes) <= M.MOST and sum(sizes) == len(body)


def test_long_runs_and_forgetting():
    known = M.Chunks(50_000)
    for text in ("a" * 300_000, " " * 300_000, "é " * 100_000):
        t = M.Text(text.encode(), known)
        assert t.tokens == len(TOKEN.findall(text)) and t.cut(t.tokens) == len(text)
    assert known.held <= 50_000 + M.MOST + 200


ROWS = [(i, f"word{i}  and\tmore é漢 🙂 {i * 'x '}tail" + " " * (i % 3)) for i in range(60)] + [
    (100, None), (101, ""), (102, " \t\n"), (103, "has <P> inside"), (104, "<S>"), (105, "a <M"), (None, "no id here"), (None, "no id here"), (7, "again"), (7, "again"),
    (106, "a< b <P c<S d"), (107, "x" * 50_000 + " " + "long words " * 30_000)]


def test_operator_and_round_trip(spark):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "doc_id long, text string, form string, n int").repartition(4)
    out = M.fill_in_middle(docs)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted((plain(*r) for r in ROWS), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    back = out.select("doc_id", M.restored("output", "form").alias("t")).collect()
    assert sorted((str(r.doc_id), r.t) for r in back) == sorted((str(d), t or "") for d, t in ROWS)


def test_report_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    want = {(str(d), hashlib.sha256(plain(d, t)[-1].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in ROWS}
    assert {(str(r.doc_id), r.output_sha256, r.restored_sha256) for r in M.report(docs).collect()} == want
    assert M.report(docs.limit(0)).count() == 0
    plan = M.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
