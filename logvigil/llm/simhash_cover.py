"""SimHash near-duplicates through covering locality-sensitive hashing.

Each bit position of a fingerprint gets a non-zero vector of radius + 1 bits. Table v keeps the positions whose vector
has an odd inner product with v. Up to ``radius`` differing positions span too few dimensions to rule out every v, so
some table keeps none of them and the pair collides there: no near pair is missed.

Fingerprints that share a bucket are then linked without pairing them up: each stands by its centres, the values that
differ from it in at most one position its buckets leave free. Two fingerprints have a centre in common exactly if
they differ in at most two bits, and a centre has at most 65 of them, so a bucket with any number of fingerprints
costs a bounded number of rows for each and never meets in one task. Equal fingerprints are one from the start.

Null text counts as empty; text without words has fingerprint zero and is linked like any other. Repeated rows stay
rows. A null id never becomes a component's id unless no document of it has one. An empty table gives an empty result;
other columns are ignored by ``components`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import stored

RADIUS = 2
BITS = 64


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about ``size`` bytes, so that long texts don't become one huge list."""
    if len(data) <= size:
        yield data.split()
        return
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[start:end].split()
        start = end


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """In how many of the hashes each bit is set."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(counts: np.ndarray, total: int) -> int:
    """The fingerprint of the bits that are set in over half of ``total`` hashes, as a signed 64-bit number."""
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def simhash(text: str | None, width: int = 3) -> int:
    """The fingerprint, as a signed 64-bit number."""
    counts, total, tail = np.zeros(BITS, np.int64), 0, []
    for block in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + block
        h = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in zip(*[words[i:] for i in range(width)])]
        if h:
            counts += bit_counts(np.array(h, "<u8"))
            total += len(h)
        tail = words[-(width - 1):]
    if not total:
        if not tail:
            return 0
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(tail), 42)).astype(np.int64))
    return majority(counts, total)


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    # one text at a time becomes a Python object
    return pa.array([simhash(t.as_py()) for t in texts], pa.int64())


def masks(radius: int = RADIUS) -> list[int]:
    """The kept positions of each table, as unsigned numbers."""
    vectors = [1 + i % ((2 << radius) - 1) for i in range(BITS)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, 2 << radius)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(prints: DataFrame) -> DataFrame:
    """(u, v), u > v: for each centre its smallest fingerprint with every other one. ``prints``: distinct ``fp``."""
    kept = [signed(m) for m in masks()]
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(kept)])
    keyed = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    free = F.get(F.array(*[F.lit(signed(((1 << BITS) - 1) ^ (m % (1 << BITS)))) for m in kept]), F.col("t"))
    near = keyed.join(shared, ["t", "key"]).groupBy("fp").agg(F.bit_or(free).alias("free"))
    flips = F.filter(F.array(*[F.lit(signed(1 << i)) for i in range(BITS)]), lambda b: F.col("free").bitwiseAND(b) != 0)
    centres = near.select("fp", F.explode(F.concat(F.array(F.lit(0).cast("bigint")), flips)).alias("flip"))
    groups = centres.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("centre")).agg(F.array_sort(F.collect_set("fp")).alias("fps")).filter("size(fps) > 1")
    return groups.select(F.col("fps")[0].alias("v"), F.explode(F.slice("fps", 2, BITS + 1)).alias("u")).select("u", "v").distinct()


def star_round(e: DataFrame) -> DataFrame:
    """One round of large stars, then small stars; minima are pre-aggregated and hubs are left to skew joins. Links: u > v."""
    least = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))  # a node without one is its own
    large = e.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    return large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def settled(e: DataFrame) -> bool:
    """Whether the links are stars: each node is a centre or has one link to one, not both."""
    ends = e.select("u", F.lit(1).alias("up")).union(e.select("v", F.lit(0)))
    return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.count("*").alias("c")).filter("up > 0 and c > 1").agg(F.count("*")).first()[0]


def connected(e: DataFrame) -> DataFrame:
    """(u, v): each node of the links with the smallest node it reaches, itself left out. Logarithmic in the longest chain.
    Links: u > v."""
    e = stored(e, "links")
    while not settled(e):
        e = stored(star_round(e), "stars")
    return e


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, root, component_id) for every row of ``docs``; ``root`` is the component's smallest fingerprint."""
    rows = stored(docs.select(F.col(id_col), fingerprint(F.col(text_col)).alias("fp")), "prints")
    prints = stored(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    stars = connected(links(prints.select("fp")))
    rooted = prints.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return rows.join(stored(named, "components"), "fp").select(id_col, "fp", "root", "component_id")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    return labelled(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id (null last), then of the smallest text hash."""
    mark: Column = F.xxhash64(text_col)
    marked = docs.select(F.struct("*").alias("_row"), F.col(id_col), F.col(text_col))
    named = labelled(marked.withColumn("_key", F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), mark.alias("mark"))).drop(id_col), "_key", text_col)
    best = named.groupBy("root").agg(F.min("_key").alias("k")).select("k.*")
    keyed = marked.select("_row", F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_i"), F.col(id_col).isNull().alias("_n"), mark.alias("_m"))
    keep = best.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_i"), F.col("none").alias("_n"), F.col("mark").alias("_m"))
    first = F.row_number().over(Window.partitionBy("_i", "_n", "_m").orderBy(F.lit(1)))
    return keyed.join(keep, ["_i", "_n", "_m"], "left_semi").withColumn("_k", first).filter("_k = 1").select("_row.*")
