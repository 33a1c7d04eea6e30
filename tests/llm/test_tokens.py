"""Token shards, the separator scan and the pipeline against plain encoders and brute force."""

import base64
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from logvigil.llm import separator_scan as C
from logvigil.llm import token_shards as T
from logvigil.llm import tokens as K
from logvigil.llm.common import stored, table

TEXTS = [(1, "Hello  world, it's 1999!\n\nEnd. "), (2, None), (3, ""), (4, "é" * 3000 + " <|endoftext|> x"), (5, "word " * 30_000), (5, "word " * 30_000), (None, " \t lone"), (6, "日本 語  x")]


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(K.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=K.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, 1) for d, t in TEXTS], "doc_id long, text string, piece int").repartition(3)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_a_bijection_and_inverts(n):
    x = np.arange(n)
    y = T.permute(x, n, 5)
    assert sorted(y) == list(x) and list(T.permute(y, n, 5, back=True)) == list(x)
    assert n < 17 or list(y) != list(T.permute(x, n, 6))


def test_shards_round_trip(spark, docs, plain):
    table_ = stored(T.shards(docs, length=64, shard_rows=50, ranges=3), "shards")
    rows = T.read_from(table_, 0, 50).collect()
    n = len(rows)
    assert sorted(r.slot for r in rows) == list(range(n))
    assert all(r.n_seq == (50 if r.shard < (n - 1) // 50 else n - 50 * r.shard) and len(r.payload) == r.n_seq * r.stride for r in table_.collect())
    texts, now = [], {}
    for r in rows:
        now.setdefault((r.doc_id, r.piece), []).append(np.frombuffer(r.tokens, "<u2").tolist())
    for d, t in {(d, t) for d, t in TEXTS}:
        want = plain.encode_ordinary(t or "") + [K.END_OF_DOCUMENT]
        want += [K.END_OF_DOCUMENT] * (-len(want) % 64)
        times = sum(x[0] == d for x in TEXTS)
        for i in range(len(want) // 64):
            assert now[(d, i)] == [want[64 * i:64 * i + 64]] * times
    part = T.read_from(table_, 120, 50)
    assert sorted(r.slot for r in part.collect()) == list(range(120, n))
    assert T.shards(docs.limit(0)).count() == 0


def test_export_writes_fixed_stride_files(spark, docs, tmp_path):
    table_ = stored(T.shards(docs, length=64, shard_rows=50), "shards")
    files = T.export(table_, f"file://{tmp_path}/out").collect()
    for r in table_.collect():
        f = next(x for x in files if x.shard == r.shard)
        assert open(f.file, "rb").read() == bytes(r.payload) and f.bytes == r.n_seq * r.stride


def test_scan_counts_tokens(spark, docs, plain, monkeypatch):
    want = sorted((str(d), len(plain.encode_ordinary(t or ""))) for d, t in TEXTS)
    for block in (7, 1 << 16):
        monkeypatch.setattr(C, "GROUP", 5)
        got = sorted((str(r.doc_id), r.n_tokens) for r in C.corpus_counts(docs, block).collect())
        assert got == want
    assert C.corpus_counts(docs.limit(0)).count() == 0


def test_scan_of_flat_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "GROUP", 4)
    rng, want = random.Random(2), []
    for i in range(3):
        x = np.array([9 if rng.random() < (0.2, 0.01, 0)[i] else 1 for _ in range(1000 + i)], "<u2")
        x.tofile(tmp_path / f"{i}.bin")
        start = 0
        for k, at in enumerate(np.flatnonzero(x == 9)):
            want.append((i, k, start, int(at) - start, True))
            start = int(at) + 1
        if start < len(x):
            want.append((i, int((x == 9).sum()), start, len(x) - start, False))
    (tmp_path / "3 odd%name.bin").write_bytes(b"")
    flat = C.read_flat(spark, str(tmp_path), 16, run=5)
    assert flat.select(F.spark_partition_id()).distinct().count() > 3 and flat.filter("length(tokens) > 32").count() == 0  # one file, many tasks
    got = C.documents(flat, 9).collect()
    assert sorted((int(r.file[-5]), r.doc, r.start, r.n_tokens, r.closed) for r in got) == want
    blocks = spark.createDataFrame([(1, 0, None), (1, 1, b""), (1, 2, b"\x09\x00\x01\x00")], "file int, block long, tokens binary")
    assert [(r.doc, r.n_tokens, r.closed) for r in C.documents(blocks, 9).orderBy("doc").collect()] == [(0, 0, True), (1, 1, False)]


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    seen, now = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stored(stage(spark, now, sf), "stage")
        assert now.columns == docs.columns
        seen.append(now.count())
    assert 0 < seen[2] <= seen[1] < seen[0] < docs.count()
    last = corpus_pipeline.run(spark, sf)
    got = last.select(F.explode(F.arrays_zip("doc_ids", "pieces")).alias("x")).filter("x.pieces = 0")
    assert got.count() == seen[3]  # one first piece for each copy


def test_pipeline_on_empty_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_ranks_on_long_runs(monkeypatch):
    """Long white space, long words and texts beyond one list give the numbers of the plain encoder's pieces."""
    with open(K.VOCABULARY, "rb") as f:
        code = K.Coder(f.read())
    texts = ["a b  c\n" * 300, " " * 9000 + "x", "x" * 20_000, "é" * 9000 + "\n" * 5000 + " end", "tab\t 　 mixed 12 don't"]
    whole = [b"".join(np.array(code.ranks.encoding._encode_single_piece(p), "<u2").tobytes() for p in code.ranks.pattern.findall(t)) for t in texts]
    assert [code.encode(t) for t in texts] == whole
    assert len(code.encode(" " * 1_000_000)) > 0
    monkeypatch.setattr(K, "WHOLE", 100)
    assert [code.encode(t) for t in texts] == whole
