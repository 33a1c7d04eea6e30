"""Language-model scoring with a log-frequency Bloom filter.

1. *Blocks.* Texts become rows of about 4 MB of text: a vocabulary, the most frequent words first and equally frequent ones
   sorted, and the token numbers, which pack well in that order. The stored blocks are read from then on; texts are split into words once.
2. *Counts.* Each block sends its vocabulary with counts, cut into hash buckets, to the bucket that adds them up
   exactly and answers every block with the totals of its own words. A frequent word is one entry a block.
   Pairs of neighbours are counted likewise, as sorted hashes of 44 bits beside the bucket's number, sent as their differences.
3. *Filter.* A pair counted c times is in the filter with the levels 1 .. 1 + log_base(c). Each bucket builds
   its own part of the filter. Probing level after level until one misses gives the quantised count back. The bits of level 1
   follow the vocabulary, so that a context has ``FALSE`` false followers in the mean.
4. *Scores.* Every block is scored by itself: the exact unigram base, and the model, a bigram probability interpolated with
   smoothed unigrams (Jelinek-Mercer by the level of the context's count):
   (1 - left) least(c(u, w)) / (c(u) + FALSE) + left uni(w). Counts of words are exact, those of pairs are the least of
   their level, never above those of their words. Pairs of a context add up to c(u) at most, false ones
   to FALSE in the mean, so the probabilities after a context sum to 1 at most, in the mean over the filter's hashes; one
   context in twenty has a false follower and may exceed that. ``left`` is one minus the discounted share of a level's tokens
   that kept pairs explain, summed up over all training tokens.

The number of buckets follows the corpus, so that a bucket stays near ``BUCKET`` entries. The filter grows with
the corpus too. What is broadcast at once is bounded: parts above ``max_bytes`` are probed in further passes over the blocks,
each with its own range of pair buckets, one after the other; the driver holds the parts of one pass. Words are never
collected: each block carries the counts of its own. All training pairs are in the filter; ``min_pairs`` above 1 makes a
smaller one of the more frequent pairs only. Counts cover all training rows.

Null text counts as empty, which is the end token alone. A null id counts as fold 0. Repeated rows count as
often as they occur and are scored each. An empty table gives an empty result. Without training rows all counts are 0.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, stored

FOLDS = 10
BLOCK = 4 << 20  # bytes of text
BUCKET = 2_000_000  # entries of a bucket
MAX_BYTES = 128 << 20  # every Python worker holds its own copy
FALSE = 0.05  # false followers of a context, in the mean
ENTRY = 44  # bits that tell the entries of a bucket apart
WIDE = 6  # bytes that hold them
CHUNK = 1 << 16  # keys probed at once
LEVELS = 128  # of context counts
END = b""
U = np.uint64
END_HASH = U(xxhash.xxh64_intdigest(END, 7))


def pack(data: bytes) -> bytes:
    """Length and zstd frame; shuffles and stored tables hold little else than such cells."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def planes(numbers: np.ndarray, wide: int) -> bytes:
    """The low ``wide`` bytes of integers as packed planes of bytes, which compress better than the numbers."""
    return pack(numbers.view(np.uint8).reshape(-1, numbers.itemsize)[:, :wide].T.tobytes())


def from_planes(data: bytes, wide: int, kind: str) -> np.ndarray:
    raw = np.frombuffer(unpack(data), np.uint8).reshape(wide, -1).T
    out = np.zeros((len(raw), np.dtype(kind).itemsize), np.uint8)
    out[:, :wide] = raw
    return out.view(kind).ravel()


class _Block:
    """Documents gathered into one row."""

    def __init__(self) -> None:
        self.vocab: defaultdict[bytes, int] = defaultdict()
        self.vocab.default_factory = self.vocab.__len__
        self.ids, self.docs, self.held, self.size = [], [], [], 0

    def add(self, doc_id, held: bool, text: str | None) -> None:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        words = data.split()
        words.append(END)
        self.ids.append(np.fromiter(map(self.vocab.__getitem__, words), np.int32, len(words)))
        self.docs.append(doc_id)
        self.held.append(held)
        self.size += len(data) + 64

    def row(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        words = sorted(self.vocab)
        old = np.fromiter(map(self.vocab.__getitem__, words), np.int32, len(words))
        lens = np.fromiter(map(len, self.ids), np.int32, len(self.ids))
        tokens = np.concatenate(self.ids)
        order = np.argsort(-np.bincount(tokens, minlength=len(words))[old], kind="stable")
        place = np.empty(len(order), np.int32)
        place[old[order]] = np.arange(len(order), dtype=np.int32)
        tokens = place[tokens]
        counts = np.bincount(tokens[np.repeat(~np.array(self.held, bool), lens)], minlength=len(words)).astype("<i4")
        one = lambda x, t: pa.array([x], t)
        return pa.RecordBatch.from_arrays([
            one(block, pa.int64()), one(self.docs, pa.list_(id_type)), one(np.packbits(self.held).tobytes(), pa.binary()), one(lens.tobytes(), pa.binary()),
            one(planes(tokens.astype("<i4"), 4), pa.binary()), one(pack(b"\n".join(words[i] for i in order)), pa.binary()), one(pack(counts.tobytes()), pa.binary()), one(len(words), pa.int32())],
            ["block", "docs", "held", "lens", "tokens", "words", "counts", "n"])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in words), U, len(words))


def blocks(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, k, now = TaskContext.get().partitionId() << 24, 0, _Block()
        id_type = None
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for d, h, t in zip(b.column("doc_id").to_pylist(), b.column("held").to_pylist(), b.column("text")):
                now.add(d, h, t.as_py())
                if now.size >= BLOCK:
                    yield now.row(base + k, id_type)
                    k, now = k + 1, _Block()
        if now.docs:
            yield now.row(base + k, id_type)

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == 0).alias("held"), "text")
    return stored(rows.mapInArrow(gather, f"block bigint, docs array<{kind}>, held binary, lens binary, tokens binary, words binary, counts binary, n int"), "blocks")


def keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The leading ``ENTRY + bits`` bits of a hash: bucket, then the bits that tell its entries apart."""
    return hashes >> U(64 - ENTRY - bits)


def bucket_of(keys_: np.ndarray) -> np.ndarray:
    return (keys_ >> U(ENTRY)).astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser with good avalanche (fixed constants of SplitMix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def runs(sorted_: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])[: len(sorted_)])


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * U(0x9E3779B97F4A7C15) + (right ^ (right >> U(29))))


@dataclass
class Shape:
    base: float = 1.5  # of the logarithm
    bits: int = 10  # of the filter for each n-gram and level
    probes: int = 5
    first_bits: int = 10  # for level 1
    first_probes: int = 5

    def for_words(self, distinct: int) -> Shape:
        """With as many bits at level 1 as leave ``FALSE`` false followers among ``distinct`` words. Seven tenths of the
        probes that need the fewest bits take 4 % more bits."""
        need = math.log2(max(2, distinct) / FALSE)
        probes = math.ceil(0.7 * need)
        return replace(self, first_bits=math.ceil(-probes / math.log(1 - 2 ** (-need / probes))), first_probes=probes)

    def level(self, counts: np.ndarray) -> np.ndarray:
        return 1 + np.floor(np.log(counts) / np.log(self.base) + 1e-9).astype(np.int64)

    def context_level(self, counts: np.ndarray) -> np.ndarray:
        """Level of any count, 0 included, below ``LEVELS``."""
        return np.where(counts > 0, np.minimum(self.level(np.maximum(counts, 1)), LEVELS - 1), 0)

    def least(self, levels: np.ndarray) -> np.ndarray:
        """Smallest of the integers that share a level; 0 for level 0."""
        return np.where(levels > 0, np.ceil(self.base ** (levels - 1.0) - 1e-9), 0.0)

    def count(self, levels: np.ndarray) -> np.ndarray:
        """Middle of the integers that share a level; 0 for level 0."""
        low, high = self.least(levels), np.ceil(self.base ** levels.astype(float) - 1e-9) - 1
        return np.where(levels > 0, (low + np.maximum(low, high)) / 2, 0.0)

    def probes_at(self, level: int) -> int:
        return self.first_probes if level == 1 else self.probes

    @staticmethod
    def steps(keys_: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First hash of each key at a level, and the step to the next."""
        a = mixed(keys_ + np.array(level, U) * U(0xD1342543DE82EF95))
        return a, mixed(a + U(0x2545F4914F6CDD1D)) | U(1)

    @staticmethod
    def place(a: np.ndarray, size: np.ndarray | U) -> np.ndarray:
        """A hash as a place below ``size``, which is below 2^32."""
        return ((a >> U(32)) * size) >> U(32)

    def part(self, keys_: np.ndarray, counts: np.ndarray) -> bytes:
        """The filter of one bucket."""
        levels = self.level(counts) if len(counts) else np.zeros(0, np.int64)
        size = max(64, len(levels) * self.first_bits + int((levels - 1).sum()) * self.bits)
        bits = np.zeros(size, bool)
        for lo in range(0, len(keys_), CHUNK):
            k, of, at = keys_[lo:lo + CHUNK], levels[lo:lo + CHUNK], 1
            while len(k):
                a, step = self.steps(k, at)
                for _ in range(self.probes_at(at)):
                    bits[self.place(a, U(size)).view(np.int64)] = True
                    a += step
                at += 1
                k, of = k[of >= at], of[of >= at]
        return size.to_bytes(8, "little") + np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """Parts of buckets in any order; a bucket may be missing (nothing is in it)."""

    def __init__(self, parts: Iterable[tuple[int, bytes]], bits: int, shape: Shape):
        self.bits, self.shape = bits, shape
        self.size, self.start = np.zeros(1 << bits, U), np.zeros(1 << bits, U)
        data = bytearray()
        for bucket, blob in parts:
            self.size[bucket], self.start[bucket] = int.from_bytes(blob[:8], "little"), len(data)
            data += memoryview(blob)[8:]
        self.data = np.frombuffer(data, np.uint8)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Quantised counts by repeated membership probes."""
        out = np.zeros(len(hashes), np.int64)
        for lo in range(0, len(hashes), CHUNK):
            self._probe(keys(hashes[lo:lo + CHUNK], self.bits), out[lo:lo + CHUNK])
        return out

    def _probe(self, k: np.ndarray, out: np.ndarray) -> None:
        bucket = bucket_of(k)
        rest = np.flatnonzero(self.size[bucket])
        k, size, start, level = k[rest], self.size[bucket[rest]], self.start[bucket[rest]], 1
        while len(rest):
            a, step = self.shape.steps(k, level)
            alive, probes = np.ones(len(rest), np.uint8), self.shape.probes_at(level)
            for i in range(1, probes + 1):
                p = self.shape.place(a, size)
                alive &= self.data.take((start + (p >> U(3))).view(np.int64)) >> (p & U(7)).astype(np.uint8)
                a += step
                if i in (1, 2, 4, probes):  # in between, the few that miss cost less than leaving them out
                    on = np.flatnonzero(alive & 1)
                    rest, k, size, start, a, step, alive = (x[on] for x in (rest, k, size, start, a, step, alive))
            out[rest] = level
            level += 1


def _bits(entries: int) -> int:
    return min(20, max(0, math.ceil(math.log2(max(1, entries) / BUCKET))))


def by_bucket(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket, and where the buckets' ranges start and end in it."""
    bucket = bucket_of(keys(hashes, bits))
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange((1 << bits) + 1))


def word_counts(rows: DataFrame, shape: Shape) -> tuple[DataFrame, int]:
    """Stored (bucket, block, counts, total, distinct, known): answers to the blocks, and one row for each bucket with its
    training tokens, its distinct training tokens, and its training tokens by level of their count. Beside it the bits of a bucket's number."""
    bits = _bits(rows.agg(F.sum("n")).first()[0] or 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, words, counts in zip(b.column("block").to_pylist(), b.column("words").to_pylist(), b.column("counts").to_pylist()):
                words, counts = unpack(words).split(b"\n"), np.frombuffer(unpack(counts), "<i4")
                order, edges = by_bucket(word_hashes(words), bits)
                found = [(i, block, pack(b"\n".join([words[w] for w in order[x:y]])), pack(counts[order[x:y]].tobytes())) for i, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "block", "words", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = defaultdict(int)
        split = [unpack(w).split(b"\n") for w in frame["words"]]
        for words, counts in zip(split, frame["counts"]):
            for w, c in zip(words, np.frombuffer(unpack(counts), "<i4").tolist()):
                total[w] += c
        answers = [planes(np.fromiter(map(total.__getitem__, words), "<i8", len(words)), 8) for words in split]
        out = pd.DataFrame({"bucket": frame["bucket"], "block": frame["block"], "counts": answers, "total": None, "distinct": None, "known": None})
        c = np.fromiter((n for n in total.values() if n), np.int64)
        known = np.bincount(shape.context_level(c), c, LEVELS).astype(np.int64).tolist()
        end = pd.DataFrame({"bucket": [int(frame["bucket"].iloc[0])], "block": None, "counts": None, "total": [int(c.sum())], "distinct": [len(c)], "known": [known]})
        return pd.concat([out.astype(object), end.astype(object)], ignore_index=True)

    sent = rows.select("block", "words", "counts").mapInArrow(cut, "bucket int, block bigint, words binary, counts binary")
    return stored(sent.groupBy("bucket").applyInPandas(add, "bucket int, block bigint, counts binary, total bigint, distinct bigint, known array<bigint>"), "words"), bits


BLOCK_COLUMNS = ("held", "lens", "tokens", "words", "answers")


def _block_arrays(b: pa.RecordBatch, i: int, word_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Held-out marks and lengths of the texts, their tokens, hashes and exact training counts of the words."""
    held, lens, tokens, words, answers = (b.column(c)[i].as_py() for c in BLOCK_COLUMNS)
    lens_, hashes = np.frombuffer(lens, "<i4"), word_hashes(unpack(words).split(b"\n"))
    exact = np.empty(len(hashes), np.int64)
    exact[by_bucket(hashes, word_bits)[0]] = np.concatenate([from_planes(x, 8, "<i8") for x in answers])
    return np.unpackbits(np.frombuffer(held, np.uint8))[: len(lens_)].astype(bool), lens_, from_planes(tokens, 4, "<i4"), hashes, exact


def _contexts(tokens: np.ndarray, lens: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of the token before each token (the end token before the first of a text), and starts of the texts."""
    starts = np.cumsum(lens) - lens
    context = np.empty(len(tokens), np.int32)
    context[1:], context[starts] = tokens[:-1], np.flatnonzero(hashes == END_HASH)[0]
    return hashes[context], context, starts


def pair_parts(rows: DataFrame, word_bits: int, tokens: int, shape: Shape, min_pairs: int) -> tuple[DataFrame, int]:
    """Stored (bucket, part, seen, kinds): the filter of neighbouring pairs, and for each level of context counts the
    tokens (as the filter will give them back) and the kinds of its kept pairs."""
    bits = _bits(tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                held, lens, toks, words, exact = _block_arrays(b, i, word_bits)
                before, context, _ = _contexts(toks, lens, words)
                use = np.repeat(~held, lens)
                k = keys(pair_hashes(before[use], words[toks[use]]), bits)
                order = np.argsort(k)
                first = runs(k[order])
                k, c = k[order[first]], np.diff(np.append(first, len(order)))
                of = shape.context_level(exact).astype(np.uint8)[context[use][order[first]]]
                out = []
                for once in (True, False):
                    pick = (c == 1) == once
                    kk, cc, ll = k[pick], c[pick], of[pick]
                    edges = np.searchsorted(bucket_of(kk), np.arange((1 << bits) + 1))
                    out += [(j, planes(np.diff(kk[x:y], prepend=U(j << ENTRY)), WIDE), b"" if once else planes(cc[x:y].astype("<i4"), 4), pack(ll[x:y].tobytes())) for j, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in out], t) for j, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["bucket", "pairs", "counts", "levels"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame["bucket"].iloc[0])
        found = [np.cumsum(from_planes(p, WIDE, "<u8")) for p in frame["pairs"]]
        k = np.concatenate(found)
        of = np.concatenate([np.frombuffer(unpack(x), np.uint8) for x in frame["levels"]])
        c = np.concatenate([from_planes(x, 4, "<i4") if x else np.ones(len(p), np.int32) for p, x in zip(found, frame["counts"])])
        order = np.argsort(k)
        k, c = k[order], c[order].astype(np.int64)
        first = runs(k)
        total = np.add.reduceat(c, first)
        kept = total >= min_pairs
        of, total, k = of[order][first][kept], total[kept], k[first][kept]
        seen, kinds = np.bincount(of, shape.least(shape.level(total)), LEVELS), np.bincount(of, minlength=LEVELS)
        part = shape.part((k & U((1 << ENTRY) - 1)) + (U(bucket) << U(ENTRY)), total)
        return pd.DataFrame({"bucket": [bucket], "part": [part], "seen": [seen.astype(np.int64).tolist()], "kinds": [kinds.tolist()]})

    sent = rows.select(*BLOCK_COLUMNS).mapInArrow(cut, "bucket int, pairs binary, counts binary, levels binary")
    return stored(sent.groupBy("bucket").applyInPandas(add, "bucket int, part binary, seen array<bigint>, kinds array<bigint>"), "pairs"), bits


def by_level(rows: DataFrame, column: str) -> np.ndarray:
    """Sums of an array column, place by place: one small row a level reaches the driver."""
    out = np.zeros(LEVELS)
    for r in rows.select(F.posexplode(column).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r.i] = r.x
    return out


def left_to_words(words: DataFrame, pairs: DataFrame, discount: float) -> np.ndarray:
    """Share of a context's probability that goes by its words, for each level of the context's count."""
    seen, kinds, known = by_level(pairs, "seen"), by_level(pairs, "kinds"), by_level(words, "known")
    return np.append(1.0, np.clip(1 - (seen - discount * kinds) / np.maximum(known, 1), 0.02, 1)[1:])


def probabilities(pair_counts: np.ndarray, context_counts: np.ndarray, word_counts_: np.ndarray, left: np.ndarray, norm: float) -> np.ndarray:
    """Of words after contexts, from the least counts of pairs and exact counts of words; ``left`` belongs to the contexts."""
    pair = np.minimum(pair_counts, np.minimum(context_counts, word_counts_))
    return (1 - left) * pair / (context_counts + FALSE) + left * (word_counts_ + 0.1) / norm


@dataclass
class Model:
    rows: DataFrame  # blocks with the counts of their words
    word_bits: int  # of the buckets that counted them
    pairs: DataFrame  # parts of the filter
    pair_bits: int
    shape: Shape
    left: np.ndarray
    tokens: int
    distinct: int

    @property
    def norm(self) -> float:
        return self.tokens + 0.1 * (self.distinct + 1)

    def filter(self, first: int = 0, past: int = 1 << 30) -> Filter:
        """The parts of a range of buckets, gathered by the driver one stored file after the other."""
        got = self.pairs.filter((F.col("bucket") >= first) & (F.col("bucket") < past)).select("bucket", "part")
        return Filter(((r[0], r[1]) for r in got.toLocalIterator()), self.pair_bits, self.shape)


def fit(docs: DataFrame, shape: Shape | None = None, min_pairs: int = 1, discount: float = 0.75) -> Model:
    shape = shape or Shape()
    rows = blocks(docs)
    words, word_bits = word_counts(rows, shape)
    n, v = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    shape = shape.for_words(v)
    answers = words.filter("block is not null").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "counts"))).alias("a")).select("block", F.col("a.counts").alias("answers"))
    rows = stored(rows.select("block", "docs", "held", "lens", "tokens", "words").join(answers, "block"), "answered")
    pairs, pair_bits = pair_parts(rows, word_bits, n, shape, min_pairs)
    return Model(rows, word_bits, pairs, pair_bits, shape, left_to_words(words, pairs, discount), n, v)


def scores(docs: DataFrame, max_bytes: int = MAX_BYTES, **how) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    model = fit(docs, **how)
    word_bits, pair_bits, shape, by_words, n, norm = model.word_bits, model.pair_bits, model.shape, model.left, model.tokens, model.norm
    ranges = [[0, 0]]
    for bucket, size in model.pairs.select("bucket", F.octet_length("part")).orderBy("bucket").collect():  # one small row a bucket
        if ranges[-1][1] and ranges[-1][1] + size > max_bytes:
            ranges.append([bucket, 0])
        ranges[-1][1] += size
    firsts = [r[0] for r in ranges]

    def judge(pair_filter, first: int, past: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    held, lens, toks, hashes, exact = _block_arrays(b, i, word_bits)
                    before, context, starts = _contexts(toks, lens, hashes)
                    if first:  # other columns come from the first pass
                        base, known = np.zeros(len(lens)), np.zeros(len(lens), np.int64)
                    else:
                        base = np.add.reduceat(np.log10((exact + 0.1) / norm)[toks], starts)
                        known = np.add.reduceat((exact > 0).astype(np.int64)[toks], starts)
                    h = pair_hashes(before, hashes[toks])
                    bucket = bucket_of(keys(h, pair_bits))
                    mine = np.flatnonzero((bucket >= first) & (bucket < past))
                    mine = mine[np.argsort(h[mine])]
                    first_of = runs(h[mine])
                    kinds = mine[first_of]
                    of = exact[context[kinds]]
                    p = probabilities(shape.least(pair_filter.value.levels(h[kinds])), of, exact[toks[kinds]], by_words[shape.context_level(of)], norm)
                    logs = np.zeros(len(toks))
                    logs[mine] = np.repeat(np.log10(np.minimum(p, 1)), np.diff(np.append(first_of, len(mine))))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(lens), b.column("block")[i].as_py())), pa.array(np.arange(len(lens), dtype=np.int32)), b.column("docs")[i].values, pa.array(held), pa.array(lens.astype(np.int64)),
                        pa.array(known), pa.array(np.full(len(lens), n, np.int64)), pa.array(base), pa.array(np.add.reduceat(logs, starts))],
                        ["block", "place", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        return run

    out = None
    for first, past in zip(firsts, [*firsts[1:], 1 << 30]):
        pair_filter = spark.sparkContext.broadcast(model.filter(first, past))  # max_bytes, or one bucket
        part = model.rows.mapInArrow(judge(pair_filter, first, past), f"block bigint, place int, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
        if len(firsts) > 1:  # done before the next filter is made
            part = stored(part, "pass")
            pair_filter.destroy()
        out = part if out is None else out.unionByName(part)
    if len(firsts) > 1:
        same = [F.first(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "train_tokens")]
        out = out.groupBy("block", "place").agg(*same, *[F.sum(c).alias(c) for c in ("n_known", "base_score", "score")])
        out = out.select("block", "place", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return out.drop("block", "place")
