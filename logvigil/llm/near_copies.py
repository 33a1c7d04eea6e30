"""Near-duplicate documents by the Jaccard similarity of their word shingles: fingerprints find, exact sets decide.

A document is the set of its shingles of five lower-cased words. Two searches name candidate pairs, and a pair is linked only
if the Jaccard similarity of the two sets, computed from the texts, is ``least`` or more:

1. *SimHash with a covering* (``simhash_cover``): one fingerprint of 64 bits over the set, and the covering's masks for ``REACH``
   differing bits. Fingerprints that differ in as many bits or fewer keep the same bits under some mask. Each set is compared with
   the first one of each of its buckets; then, in buckets that these links have not made one component, every two sets of
   different components are (``apart``). So any two sets that share a bucket are compared or are linked already.
2. *MinHash bands*, for what the covering cannot reach: sets of similarity 0.8 differ in some ten bits, and each further bit doubles
   the masks. Each of ``BANDS`` bands joins ``ROWS`` independent minima of the set; two sets of similarity 0.8 agree in none of the
   bands with a chance of (1 - 0.8^4)^24 = 3e-6.

Links are closed by star contraction. Equal sets are one from the start.

A bucket of the bands of up to ``SMALL`` sets compares all its pairs. A larger one compares each set with at most ``SLOTS`` centres,
always among them the set that shares the most buckets, counted with their sizes (the text others were edited
from), and is then split by two and by four bands at once. So a set costs a bounded number of rows, however many copies
it has, and no bucket meets in one task. Only in buckets of the bands that are large at all three depths two similar sets may be
compared with neither each other nor a common centre.

Null text counts as empty; texts without words have one set in common. Texts of fewer than five words are one shingle.
Repeated rows stay rows of one set. An empty table gives an empty result; other columns are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import stored
from .lm_bloom import mixed
from .simhash_cover import bit_counts, connected, majority, masks, signed, word_blocks

WIDTH = 5
LEAST = 0.8
REACH = 4  # differing bits that the covering bears: 31 masks
BANDS, ROWS = 24, 4
SMALL = 8
SLOTS = 8
PART = 512
DEPTHS = (1, 2, 4)  # bands at once
U = np.uint64
_rng = np.random.default_rng(20)
_FLIP, _TIMES = (_rng.integers(0, 1 << 63, BANDS * ROWS, U) * U(2) + U(1) for _ in range(2))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles as sorted hashes of 64 bits."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    words = np.concatenate([np.fromiter(map(xxhash.xxh64_intdigest, block), U, len(block)) for block in word_blocks(data)])
    span = min(width, len(words))
    h = np.full(max(1, len(words) - width + 1), U(span))
    for i in range(span):
        h = mixed(h * U(0x9E3779B97F4A7C15) + words[i:i + len(h)])
    return np.unique(h)


def signature(text: str | None) -> np.ndarray:
    """A hash of the set, its SimHash fingerprint, a hash of each band, then the number of shingles."""
    h = shingle_set(text)
    least = np.full(BANDS * ROWS, ~U(0))
    for lo in range(0, len(h), 1024):
        np.minimum(least, ((h[lo:lo + 1024, None] ^ _FLIP) * _TIMES).min(0), out=least)
    bands, parts = np.arange(BANDS, dtype=U), least.reshape(BANDS, ROWS)
    for i in range(ROWS):
        bands = mixed(bands * U(0x9E3779B97F4A7C15) + parts[:, i])
    own = xxhash.xxh64_intdigest(h.tobytes(), 42)
    return np.concatenate([np.array([own], U).view(np.int64), [majority(sum(bit_counts(h[lo:lo + 4096]) for lo in range(0, len(h), 4096)), len(h))], bands.view(np.int64), [len(h)]])


@F.arrow_udf(ArrayType(LongType()))
def signatures(texts: pa.Array) -> pa.Array:
    return pa.array([signature(t.as_py()) for t in texts], pa.list_(pa.int64()))


def shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` as a side that no join broadcasts: Spark sizes exploded rows like those they come from, and stored ones by their
    compressed files."""
    return rows.hint("merge")


def _keyed(sets: DataFrame, depth: int, large: DataFrame | None = None) -> DataFrame:
    """(fp, band, key): the bucket of each set in each band, by ``depth`` bands at once; only those of ``large`` (fp, band)."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda t: F.xxhash64(t, F.slice(F.concat("bands", "bands"), t + 1, F.lit(depth))))
    if large is None:
        return sets.select("fp", F.posexplode(keys).alias("band", "key"))
    wanted = large.groupBy("fp").agg(F.collect_list("band").alias("wanted"))  # at most BANDS
    return sets.join(wanted, "fp").select("fp", "wanted", F.posexplode(keys).alias("band", "key")).filter(F.array_contains("wanted", F.col("band"))).drop("wanted")


def candidates(sets: DataFrame) -> DataFrame:
    """(u, v), u > v: pairs of sets that may be similar. ``sets``: distinct ``fp`` with ``bands``."""
    found, popular, large = [], None, None
    for depth in DEPTHS:
        rows = _keyed(sets, depth, large)
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        shared = stored(shuffled(rows).join(sizes, "key"), "buckets")
        if popular is None:
            popular = stored(shared.groupBy("fp").agg(F.sum("n").alias("popular")), "popular")
        small, large = shared.filter(F.col("n") <= SMALL), shared.filter(F.col("n") > SMALL)
        whole = small.groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
        one = whole.select("fps", F.posexplode("fps").alias("i", "u"))
        found.append(one.select("u", F.explode(F.slice("fps", 1, F.col("i"))).alias("v")))
        if large.isEmpty():
            break
        ranked = shuffled(large).join(popular, "fp").groupBy("key", F.pmod(F.xxhash64("fp"), F.lit(SLOTS)).alias("slot")).agg(F.max(F.struct("popular", "fp")).alias("top"))
        centres = ranked.groupBy("key").agg(F.collect_list("top.fp").alias("centres"))
        # a set's centres over all its bands, each once: at most BANDS * SLOTS, few where the bands agree
        mine = shuffled(large.select("key", "fp")).join(centres, "key").groupBy("fp").agg(F.array_distinct(F.flatten(F.collect_list("centres"))).alias("all"))
        met = mine.select("fp", F.explode(F.array_remove("all", F.col("fp"))).alias("c"))
        found.append(met.select(F.greatest("fp", "c").alias("u"), F.least("fp", "c").alias("v")))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def covering(sets: DataFrame) -> DataFrame:
    """Stored (fp, key, first): the sets of each bucket of the covering that has two or more, with the smallest one. Sets of
    one fingerprint share all their buckets. ``sets``: distinct ``fp`` with ``print``."""
    keys = F.array(*[F.xxhash64(F.lit(t), F.col("print").bitwiseAND(F.lit(signed(m)))) for t, m in enumerate(masks(REACH))])
    keyed = sets.select("fp", F.explode(keys).alias("key"))
    first = keyed.groupBy("key").agg(F.min("fp").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return stored(shuffled(keyed).join(first, "key").select("fp", "key", "first"), "covering")


def covered(sets: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """(u, v), u > v: each set with the first of each of its buckets of ``covering``; ``apart`` names the others that are needed."""
    buckets = covering(sets) if buckets is None else buckets
    return stored(buckets.filter("fp <> first").select(F.col("fp").alias("u"), F.col("first").alias("v")).distinct(), "covered")


def apart(buckets: DataFrame, sets: DataFrame, stars: DataFrame, least: float = LEAST) -> DataFrame:
    """(u, v), u > v: the sets that share a bucket but no component. Left out are pairs whose numbers of shingles alone keep them
    below ``least``. ``sets``: distinct ``fp`` with ``size``; ``stars``: (u, v) of ``connected``.

    A bucket is cut into parts of about ``PART`` sets, and any two parts meet by themselves: no task holds a large bucket.
    """
    roots = sets.select("fp", "size").join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rows = shuffled(buckets.select("fp", "key")).join(roots, "fp")
    mixed_ = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).filter("low <> high")
    parts = F.ceil(F.col("n") / PART).cast("int")
    open_ = stored(rows.join(mixed_.select("key", parts.alias("parts")), "key").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")), "apart")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    a = open_.select("key", F.col("part").alias("p"), others.alias("q"), F.col("fp").alias("u"), F.col("root").alias("ru"), F.col("size").alias("su"))
    b = open_.select("key", others.alias("p"), F.col("part").alias("q"), F.col("fp").alias("v"), F.col("root").alias("rv"), F.col("size").alias("sv"))
    near = shuffled(a).join(shuffled(b), ["key", "p", "q"]).filter(F.expr(f"u > v and ru <> rv and least(su, sv) / greatest(su, sv) >= {least}D"))
    return near.select("u", "v").distinct()


def similar(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of ``least`` or more. ``texts``: (fp, text), one row a set."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for left, right in zip(b.column("a"), b.column("b")):
                x, y = shingle_set(left.as_py()), shingle_set(right.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both / (len(x) + len(y) - both) >= least)
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a, b = texts.toDF("u", "a"), texts.toDF("v", "b")
    return pairs.join(shuffled(a), "u").join(shuffled(b), "v").select("u", "v", "a", "b").mapInArrow(judge, "u bigint, v bigint")


def linked(pairs: DataFrame, rows: DataFrame, sets: DataFrame, text_col: str, least: float) -> DataFrame:
    """The similar ones of ``pairs``; of each set the text of one row is read."""
    pairs = stored(pairs, "pairs")
    asked = pairs.select(F.col("u").alias("fp")).union(pairs.select("v")).distinct()
    # stored first: few places then need no shuffle of all texts
    places = stored(sets.select("fp", "_place").join(asked, "fp", "left_semi").select("_place"), "places")
    texts = stored(rows.select("_place", "fp", F.col("_row")[text_col].alias("text")).join(places, "_place", "left_semi").select("fp", "text"), "texts")
    return similar(pairs, texts, least)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Stored (_row, _place, fp): the rows with a unique number and their set; and (fp, root): the smallest set of each
    set's component."""
    marked = docs.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_place"), signatures(F.col(text_col)).alias("_s"))
    rows = stored(marked.select("_row", "_place", F.get("_s", F.lit(0)).alias("fp"), F.get("_s", F.lit(1)).alias("print"), F.slice("_s", 3, BANDS).alias("bands"), F.get("_s", F.lit(2 + BANDS)).alias("size")), "signed")
    sets = stored(rows.groupBy("fp").agg(F.min("_place").alias("_place"), F.first("print").alias("print"), F.first("bands").alias("bands"), F.first("size").alias("size")), "sets")
    buckets = covering(sets)
    stars = connected(linked(covered(sets, buckets).unionByName(candidates(sets)).distinct(), rows, sets, text_col, least))
    rest = stored(apart(buckets, sets, stars, least), "rest")
    if not rest.isEmpty():
        stars = connected(stars.unionByName(linked(rest, rows, sets, text_col, least)))
    named = sets.select("fp").join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return rows.select("_row", "_place", "fp"), named


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row of each component: that of the smallest id (null last), then of the smallest text hash."""
    rows, named = components(docs, id_col, text_col, least)
    own = F.col("_row")[id_col]
    key = F.struct(own.isNull().alias("none"), own.alias("id"), F.xxhash64(F.col("_row")[text_col]).alias("mark"), "_place").alias("k")
    best = rows.select("fp", key).join(named, "fp").groupBy("root").agg(F.min("k").alias("k")).select("k._place")
    return rows.join(best, "_place", "left_semi").select("_row.*")
