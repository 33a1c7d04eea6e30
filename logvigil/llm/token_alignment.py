"""Alignment of two tokenizers' outputs by sparse products over the bytes they share.

Tokens and bytes of a text form two incidence matrices in compressed rows, A (tokens of the first vocabulary by bytes) and
B. Gustavson's row product A.B' has an entry for each pair of tokens whose byte ranges overlap: the links. Bytes at which
tokens of both end cut the text into groups; tokens and groups form incidence matrices as well, whose product G_A.G_B'
links all tokens that share a group (``links="group"``). Texts are multiplied in batches, as blocks of one matrix. A long text
is cut at spaces that follow a visible character: tokens of both vocabularies end there, so nothing is lost.

1. *Texts* are encoded and multiplied once. Stored are each text's numbers, the digest of its groups, and its distinct id pairs
   with how often they are linked.
2. *Counts.* Each task adds up the stored pairs; Spark adds the tasks' sums.
3. *Sums.* The most frequent pairs, at most ``BROADCAST`` of them, are broadcast with their counts; a text's other
   pairs come out as rows and are joined by a shuffle. Each of those is rarer than all that are broadcast, so none of them is a
   hot key. The highest count of an id is a table no longer than the vocabulary.

Texts that are null, empty, or not given back byte for byte by either vocabulary have no tokens: all numbers are 0 and the
digest is ''. Repeated rows count as often as they occur. Null ids are kept. An empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .tokens import Ranks

FOLDER = "/opt/tokenizers"
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
BROADCAST = 1 << 21  # pairs; 17 bytes each
BATCH = 1 << 18  # characters multiplied at once
MERGED = 1 << 21  # pairs of a task added up at once
_BORDER = re.compile(r"(?<=\S) ")


# ---- compressed rows


@dataclass
class Csr:
    """Rows ``idx[ptr[i]:ptr[i + 1]]`` with values ``val``, over ``width`` columns."""

    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray
    width: int

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.idx, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.idx, minlength=self.width))])
        return Csr(ptr, self.row_of()[order], self.val[order], len(self.ptr) - 1)


def spans(lengths: np.ndarray) -> Csr:
    """Row i has ``lengths[i]`` neighbouring columns; together the rows cover all columns once."""
    ptr = np.concatenate([[0], np.cumsum(lengths)])
    return Csr(ptr, np.arange(ptr[-1]), np.ones(ptr[-1], np.int64), int(ptr[-1]))


def product(a: Csr, b: Csr, block: int = 1 << 20) -> Csr:
    """Gustavson's product: row i is the sum of the rows of ``b`` that row i of ``a`` names. About ``block`` terms at once."""
    each = np.diff(b.ptr)[a.idx]  # terms that an entry of a makes
    done = np.concatenate([[0], np.cumsum(each)])
    terms, rows = done[a.ptr], len(a.ptr) - 1  # terms before each row
    ptr, idx, val, lo = [np.zeros(1, np.int64)], [], [], 0
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(terms, terms[lo] + block, "right")) - 1)
        s, e = a.ptr[lo], a.ptr[hi]
        n = each[s:e]
        at = np.repeat(b.ptr[a.idx[s:e]] - (done[s:e] - done[s]), n) + np.arange(n.sum())
        row = np.repeat(np.repeat(np.arange(hi - lo), np.diff(a.ptr[lo:hi + 1])), n)
        key, v = row * b.width + b.idx[at], np.repeat(a.val[s:e], n) * b.val[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, v = key[order], v[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        ptr.append(ptr[-1][-1] + np.searchsorted(key[new] // b.width, np.arange(hi - lo), "right"))
        idx.append(key[new] % b.width)
        val.append(np.add.reduceat(v, new) if len(new) else v)
        lo = hi
    empty = [np.zeros(0, np.int64)]
    return Csr(np.concatenate(ptr), np.concatenate(idx or empty), np.concatenate(val or empty), b.width)


# ---- the two vocabularies


def _byte_alphabet() -> dict[str, int]:
    """Printable characters that stand for bytes in byte-level vocabularies: visible Latin-1 for itself, the rest from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Encoders that give the ids of texts, and the bytes of each id.

    The first file's byte-level merges are applied by the rank encoder, several times faster than the file's own library,
    if they stand in the order of their ids; tests compare both over all code points. Otherwise that library is used.
    """

    def __init__(self, first: bytes, second: bytes):
        import sentencepiece

        model, alphabet = json.loads(first)["model"], _byte_alphabet()
        self.a_bytes = [b""] * (1 + max(model["vocab"].values()))
        for piece, i in model["vocab"].items():
            if all(c in alphabet for c in piece):
                self.a_bytes[i] = bytes(alphabet[c] for c in piece)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        last = max(ids, default=255)
        ranks = {b: i for i, b in enumerate(self.a_bytes) if b and i <= last}
        if ids == sorted(ids) and len(ranks) == 256 + len(ids):
            self.first = Ranks(ranks).encode
        else:
            self.first = self.library(first)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        pieces = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8", "surrogatepass") for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")

    @staticmethod
    def library(first: bytes) -> Callable[[str], list[int]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer

        own = Tokenizer.from_str(first.decode("utf-8"))
        own.encode_special_tokens = True
        return lambda text: own.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and each text by both; none where the text does not come back."""
        a = [self.first(" " + t) for t in texts]
        b = [x if t else [self.space] for t, x in zip(texts, self.b.encode(texts, num_threads=1))]
        for i, t in enumerate(texts):
            data = (" " + t).encode("utf-8", "surrogatepass")
            if not b"".join(map(self.a_bytes.__getitem__, a[i])) == data == b"".join(map(self.b_bytes.__getitem__, b[i])):
                a[i], b[i] = [], []
        return a, b


# ---- products of a batch


@dataclass
class Measured:
    """Numbers of each text of a batch."""

    numbers: np.ndarray  # n_a, n_b, n_groups, n_links
    written: list[bytes]  # a1,a2|b1;a3|b2,b3
    pairs: Csr  # texts by id pairs


class Aligner:
    def __init__(self, vocabularies: Vocabularies, links: str = "overlap"):
        self.v, self.links = vocabularies, links
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (vocabularies.a_bytes, vocabularies.b_bytes))
        # an id with what follows it: the next one of the group, or the group's other half, or the next group
        self.signs = [b"%d%c" % (i, c) for size, ends in ((len(self.a_len), b",|"), (len(self.b_len), b",;")) for i in range(size) for c in ends]

    def measure(self, texts: list[str]) -> Measured:
        a, b = self.v.encode(texts)
        n_a, n_b = (np.array([len(x) for x in t], np.int64) for t in (a, b))
        ia, ib = (np.fromiter((i for x in t for i in x), np.int64, n.sum()) for t, n in ((a, n_a), (b, n_b)))
        rows_a, rows_b = spans(self.a_len[ia]), spans(self.b_len[ib])
        ends = np.intersect1d(rows_a.ptr[1:], rows_b.ptr[1:], assume_unique=True)  # where tokens of both end
        group_a, group_b = (np.searchsorted(ends, r.ptr[1:]) for r in (rows_a, rows_b))
        if self.links == "group":
            g_a, g_b = (Csr(np.arange(len(g) + 1), g, np.ones(len(g), np.int64), len(ends)) for g in (group_a, group_b))
            linked = product(g_a, g_b.transposed())
        else:
            linked = product(rows_a, rows_b.transposed())
        left, n = linked.row_of(), len(texts)
        text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        n_links = np.bincount(text_a[left], minlength=n)
        n_groups = np.bincount(text_b[np.searchsorted(group_b, np.arange(len(ends)))], minlength=n)
        key = ia[left] * len(self.b_len) + ib[linked.idx]
        # texts by links, times links by id pairs
        by_pair = Csr(np.arange(len(key) + 1), key, np.ones(len(key), np.int64), len(self.a_len) * len(self.b_len))
        return Measured(np.stack([n_a, n_b, n_groups, n_links], 1), self._written(ia, ib, group_a, group_b, n_a, n_b), product(spans(n_links), by_pair))

    def _written(self, ia, ib, group_a, group_b, n_a, n_b) -> list[bytes]:
        last_a, last_b = (np.diff(g, append=-1) != 0 for g in (group_a, group_b))
        at_a = np.arange(len(ia)) + np.searchsorted(group_b, group_a)  # behind the second's tokens of earlier groups
        at_b = np.arange(len(ib)) + np.searchsorted(group_a, group_b, "right")
        signs = np.empty(len(ia) + len(ib), np.int64)
        signs[at_a], signs[at_b] = 2 * ia + last_a, 2 * (len(self.a_len) + ib) + last_b
        cells, out, at = list(map(self.signs.__getitem__, signs.tolist())), [], 0
        for n in (n_a + n_b).tolist():
            out.append(b"".join(cells[at:at + n])[:-1])
            at += n
        return out


def pieces(text: str) -> Iterator[str]:
    """The text in pieces between spaces at which tokens of both vocabularies end; such a space leads the piece behind it."""
    at = 0
    while len(text) - at > BATCH:
        m = _BORDER.search(text, at + BATCH)
        if not m:
            break
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(spark: SparkSession, first: str, second: str, links: str) -> Callable[[], Aligner]:
    """A function for tasks that gives the worker's aligner. The files (under 4 MB) are read on the driver and broadcast."""
    data = []
    for path in (first, second):
        with open(path, "rb") as f:
            data.append(f.read())
    sent, key = spark.sparkContext.broadcast(tuple(data)), (hashlib.sha256(data[0] + data[1]).hexdigest(), links)

    def get() -> Aligner:
        if key not in _ALIGNERS:
            _ALIGNERS[key] = Aligner(Vocabularies(*sent.value), links)
        return _ALIGNERS[key]

    return get


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key, where = np.unique(key, return_inverse=True)
    return key, np.bincount(where, n, len(key)).astype(np.int64)


def _long(own: Aligner, text: str) -> tuple[np.ndarray, bytes, str, np.ndarray, np.ndarray] | None:
    """Numbers, group text, its digest, and id pairs of a long text, piece by piece; None where it does not come back."""
    numbers, written, digest, key, times = np.zeros(4, np.int64), [], hashlib.sha256(), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for piece in pieces(text):
        m = own.measure([piece])
        if not m.numbers[0, 0]:
            return None
        numbers += m.numbers[0]
        digest.update(b";" * bool(written) + m.written[0])
        written.append(m.written[0])
        key, times = _summed(np.concatenate([key, m.pairs.idx]), np.concatenate([times, m.pairs.val]))
    return numbers, b";".join(written), digest.hexdigest(), key, times


FIELDS = ["task int", "place bigint", "doc_id {}", "n_a bigint", "n_b bigint", "n_groups bigint", "n_links bigint", "groups_sha256 string", "groups string", "keys binary", "times binary"]


def measured(docs: DataFrame, id_col: str, text_col: str, get: Callable[[], Aligner], groups: bool) -> DataFrame:
    """Stored rows of all texts; ``keys`` and ``times`` are the distinct id pairs and how often each is linked, as 8 and 4 bytes."""
    fields = [f.format(docs.schema[id_col].dataType.simpleString()) for f in FIELDS]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, place = get(), TaskContext.get().partitionId(), 0

        def rows(ids: pa.Array, cells: list) -> pa.RecordBatch:
            nonlocal place
            n, cols = len(cells), list(zip(*cells))
            arrays = [pa.array(np.full(n, task, np.int32)), pa.array(np.arange(place, place + n)), ids, *[pa.array([int(x[i]) for x in cols[0]], pa.int64()) for i in range(4)],
                      pa.array(cols[2], pa.string()), pa.array([x.decode() if groups else "" for x in cols[1]], pa.string()),
                      pa.array([k.astype("<i8").tobytes() for k in cols[3]], pa.binary()), pa.array([t.astype("<u4").tobytes() for t in cols[4]], pa.binary())]
            place += n
            return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in fields])

        none = (np.zeros(4, np.int64), b"", "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        for b in batches:
            start, cells, texts, chars = 0, [], [], 0

            def settle() -> None:
                nonlocal texts, chars
                m = own.measure([t for t in texts if t]) if any(texts) else None
                i = 0
                for t in texts:
                    if not t:
                        cells.append(none)
                        continue
                    lo, hi = m.pairs.ptr[i], m.pairs.ptr[i + 1]
                    cells.append((m.numbers[i], m.written[i], hashlib.sha256(m.written[i]).hexdigest(), m.pairs.idx[lo:hi], m.pairs.val[lo:hi]) if m.numbers[i, 0] else none)
                    i += 1
                texts, chars = [], 0

            for i, cell in enumerate(b.column(1)):
                text = cell.as_py() or ""
                if len(text) > BATCH:
                    settle()
                    cells.append(_long(own, text) or none)
                else:
                    texts.append(text)
                    chars += len(text)
                if chars > BATCH or len(text) > BATCH:
                    settle()
                    yield rows(b.column(0).slice(start, len(cells)), cells)
                    start, cells = i + 1, []
            settle()
            if cells:
                yield rows(b.column(0).slice(start), cells)

    return stored(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(read, ", ".join(fields)), "measured")


# ---- counts of the corpus


def pair_counts(rows: DataFrame) -> DataFrame:
    """(key, n): how many links of all texts hold each pair of ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, more, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merge() -> None:
            nonlocal key, n, more, held
            key, n = _summed(np.concatenate([key, *[k for k, _ in more]]), np.concatenate([n, *[t for _, t in more]]))
            more, held = [], 0

        for b in batches:
            for k, t in zip(b.column(0), b.column(1)):
                more.append((np.frombuffer(k.as_buffer(), "<i8"), np.frombuffer(t.as_buffer(), "<u4").astype(np.int64)))
                held += len(more[-1][0])
                if held > MERGED:
                    merge()
                    if len(key) > MERGED:
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])
                        key, n = key[:0], n[:0]
        merge()
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return rows.select("keys", "times").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def ranked_pairs(counts: DataFrame, second_size: int) -> DataFrame:
    """Stored (key, n, best, level): ``best`` if no pair of the same second id is more frequent."""
    pairs = stored(counts, "pairs").withColumn("b", F.col("key") % second_size)
    top = pairs.groupBy("b").agg(F.max("n").alias("top"))  # at most one row for each id of the vocabulary
    level: Column = F.floor(16 * F.log2("n")).cast("int")
    return stored(pairs.join(F.broadcast(top), "b").select("key", "n", (F.col("n") == F.col("top")).alias("best"), level.alias("level")), "ranked")


def _least_level(ranked: DataFrame, limit: int) -> int:
    """The level from which on at most ``limit`` pairs are found."""
    held, least = 0, 1 << 30
    for r in ranked.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 1,024 levels
        held += r["count"]
        if held > limit:
            break
        least = r.level
    return least


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: str = f"{FOLDER}/{FIRST}", second: str = f"{FOLDER}/{SECOND}", links: str = "overlap", limit: int = BROADCAST, groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and, if asked, ``groups``: the group texts themselves).

    ``n_best``: links whose id pair is the corpus's most frequent one of its second id; ``count_sum``: the pairs' counts summed over the links.
    """
    spark = docs.sparkSession
    get = aligner(spark, first, second, links)
    rows = measured(docs, id_col, text_col, get, groups)
    ranked = ranked_pairs(pair_counts(rows), len(get().b_len))
    least = _least_level(ranked, limit)
    table = ranked.filter(F.col("level") >= least).select("key", "n", "best").toArrow()  # at most ``limit`` rows
    order = np.argsort(table["key"].to_numpy())
    sent = spark.sparkContext.broadcast(tuple(table[c].to_numpy()[order] for c in ("key", "n", "best")))
    rest = ranked.filter(F.col("level") < least)
    kept = [f.split()[0] for f in FIELDS[:9]]
    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in kept]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = sent.value
        for b in batches:
            sums, rare = [], []
            for k, t in zip(b.column("keys"), b.column("times")):
                key, times = np.frombuffer(k.as_buffer(), "<i8"), np.frombuffer(t.as_buffer(), "<u4").astype(np.int64)
                at = np.searchsorted(keys, key)
                hit = at < len(keys)
                hit[hit] = keys[at[hit]] == key[hit]
                at, known = at[hit], times[hit]
                sums.append((int((known * best[at]).sum()), int((known * n[at]).sum())))
                rare.append([{"key": x, "m": m} for x, m in zip(key[~hit].tolist(), times[~hit].tolist())])
            more = [pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *more, pa.array(rare, pa.list_(pa.struct([("key", pa.int64()), ("m", pa.int64())])))], [*kept, "n_best", "count_sum", "rare"])

    out = rows.mapInArrow(add, ", ".join([*kinds, "n_best bigint, count_sum bigint, rare array<struct<key:bigint,m:bigint>>"]))
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])]
    if rest.isEmpty():
        return out.select(*shown)
    summed = stored(out, "aligned")
    linked = summed.select("task", "place", F.inline("rare")).join(rest, "key")
    more = linked.groupBy("task", "place").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"), F.sum(F.col("m") * F.col("n")).alias("more_sum"))
    joined = summed.drop("rare").join(more, ["task", "place"], "left")
    return joined.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*shown)


def report(docs: DataFrame) -> DataFrame:
    return align(docs)
