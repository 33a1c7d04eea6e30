"""Exact self-join of documents by the Jaccard similarity of their word n-grams, through token-combination prefixes.

A document is the set of its distinct five-word shingles; sets are identified by a hash of 64 bits, so that copies are one
from the start. Two sets link when 100 * intersection >= 80 * union. Tokens (shingles) have one order: rare class first,
then by hash. A set of s tokens may miss at most m = s - ceil(0.8 s) tokens of a partner.

1. *Classes.* Each set shows its first 2 (m + 1) tokens by hash. A token shown by more than ``LIST`` sets is frequent. Any
   fixed class gives right results; the count only keeps lists short.
2. *Prefixes.* A set whose first m + 1 tokens are rare indexes each of them: a partner shares one. A set that reaches
   the frequent class has its prefix extended: its frequent tokens fall into q classes by hash, it indexes pairs
   within a class and takes q tokens more. Partners share the first 1 + q of their common tokens within both prefixes;
   one of them is rare, or two fall into one class. q follows the size, by powers of two, and a set indexes under both
   values that a partner's size may have, so a set has about as many keys as its prefix has tokens.
3. *Short lists* of up to ``LIST`` sets compare all pairs. A pair is dropped if the keys it shares and all tokens behind the
   prefix cannot reach the threshold.
4. *Long lists* compare each set with the list's hub, the set met most often. Sets that are linked to the hub are of one
   component and need no more. Any other set x of a hub's family lacks D_x of the hub's tokens and has A_x others; it
   can be similar to a member y only if the two share a number of these differences that follows from their counts, more than
   half of them near the threshold. So differences, rare ones first, are joined by prefixes of their own.
5. *Verification* compares whole sets. Links are closed by star contraction: those of steps 3 and 4 first, then those of differences between
   the components, not the sets, that they join.

Texts are read again for the sets that steps 1 and 5 ask for, found by a hash of the text and confirmed by that of the set.
Null and wordless texts have no shingle and link with nothing: their component is their own id. Equal sets link. Rows with
a null id belong to their component, which is null only if none of its rows has an id. Repeated rows stay. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import stored
from .lm_bloom import mixed
from .near_copies import shingle_set
from .simhash_cover import connected

WIDTH = 5
PERCENT = 80
LIST = 8  # sets of a list that is compared pair by pair
SHOWN = 2  # prefixes that a set shows
BROADCAST = 1 << 20  # rows of 8 to 24 bytes
TOKEN_BITS = 48  # of a key; verification compares 64
U = np.uint64


def missing(size, percent: int = PERCENT):
    """Tokens that a set may lack of a partner."""
    return size - (percent * size + 99) // 100


def whole_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes; none for a text without words."""
    return shingle_set(text, width) if text and text.strip(" \t\n\x0b\x0c\r") else np.zeros(0, U)


def identity(h: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(h.tobytes(), 13) - (1 << 63)


def tokens(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - TOKEN_BITS)).astype(np.int64)  # keeps the order


def _classes(size: int, percent: int) -> set[int]:
    """The values of q for partners of the same size or larger, and for smaller ones."""
    return {(1 << n.bit_length()) * (100 - percent) // 200 for n in (size, (percent * size + 99) // 100)}


def keys_of(all_: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[bool, np.ndarray]:
    """Whether the prefix reaches the frequent class, and the keys: rare tokens as they are, combinations as negative numbers."""
    m, is_frequent = missing(len(all_), percent), np.isin(all_, frequent)
    rare, common = all_[~is_frequent], all_[is_frequent]
    if len(rare) > m:
        return False, np.unique(rare[:m + 1])
    out = [rare]
    for q in _classes(len(all_), percent):
        f = common[:m + 1 + q - len(rare)].astype(U)
        if not q:
            out.append(-1 - (mixed(f) >> U(1)).astype(np.int64))
            continue
        cell = (mixed(f) % U(q)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        f, cell = f[order], cell[order]
        for step in range(1, len(f)):
            same = np.flatnonzero(cell[step:] == cell[:-step])
            if not len(same):
                break  # classes are neighbours here: nothing lies further apart
            pair = mixed(mixed(f[same] + U(q)) * U(0x9E3779B97F4A7C15) + f[same + step])
            out.append(-1 - (pair >> U(1)).astype(np.int64))
    return True, np.unique(np.concatenate(out))


def _signed(texts: pa.Array) -> pa.Array:
    prints, sizes, shown = [], [], []
    for t in texts:
        h = whole_set(t.as_py())
        prints.append(identity(h))
        sizes.append(len(h))
        shown.append(tokens(h[:SHOWN * (missing(len(h)) + 1)]))
    return pa.StructArray.from_arrays([pa.array(prints, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shown, pa.list_(pa.int64()))], ["fp", "n", "shown"])


signed = F.arrow_udf(_signed, StructType([StructField("fp", LongType()), StructField("n", LongType()), StructField("shown", ArrayType(LongType()))]))


def _prefix(shown: np.ndarray, frequent: np.ndarray, size: int) -> tuple[bool | None, np.ndarray]:
    """``keys_of`` from the shown tokens of a set of ``size``; None if the whole set must tell."""
    rare, m = shown[~np.isin(shown, frequent)] if len(frequent) else shown, missing(size)
    if len(rare) > m:
        return False, np.unique(rare[:m + 1])
    return keys_of(shown, frequent) if len(shown) >= size else (None, shown[:0])


def _side(df: DataFrame) -> DataFrame:
    """For a join: broadcast if it has few rows, else left to a shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST + 1).count() <= BROADCAST else df


def fetch(docs: DataFrame, text_col: str, wanted: DataFrame, name: str) -> DataFrame:
    """Stored (fp, h): the whole sets of ``wanted`` (fp, mark), one row each; ``h`` holds 8 bytes a shingle."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part, prints, sets = b.slice(lo, 256), [], []
                for fp, t in zip(part.column("fp").to_pylist(), part.column("text")):
                    h = whole_set(t.as_py())
                    if identity(h) == fp:
                        prints.append(fp)
                        sets.append(h.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(sets, pa.binary())], ["fp", "h"])

    texts = docs.select(F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    found = texts.join(_side(wanted), "mark").select("fp", "text").mapInArrow(read, "fp bigint, h binary")
    return stored(found.groupBy("fp").agg(F.first("h").alias("h")), name)


@F.arrow_udf(ArrayType(LongType()))
def _tokens(sets: pa.Array) -> pa.Array:
    return pa.array([tokens(np.frombuffer(h.as_buffer(), "<u8")) for h in sets], pa.list_(pa.int64()))


def prefixes(sets: DataFrame, column: str, frequent: DataFrame) -> DataFrame:
    """(fp, n, mark, short, keys) by the tokens of ``column``; ``short`` is null where the whole set must tell."""
    spark, known = sets.sparkSession, None
    if frequent.limit(BROADCAST + 1).count() <= BROADCAST:
        known = spark.sparkContext.broadcast(np.sort(frequent.toArrow()["token"].to_numpy()))
        asked = sets.select("fp", "n", "mark", column)
    else:
        held = sets.select("fp", F.explode(column).alias("token")).join(frequent, "token", "left_semi").groupBy("fp").agg(F.collect_list("token").alias("f"))  # a set's own tokens
        asked = sets.select("fp", "n", "mark", column).join(held, "fp", "left")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            short, keys = [], []
            for i, (cell, n) in enumerate(zip(b.column(3), b.column(1).to_pylist())):
                t = np.asarray(cell.values)
                if known is None:
                    f = np.asarray(b.column("f")[i].values if b.column("f")[i].is_valid else [], np.int64)
                else:
                    at = np.searchsorted(known.value, t)
                    at[at == len(known.value)] = 0
                    f = t[known.value[at] == t] if len(known.value) else t[:0]
                s, k = _prefix(t, f, n)
                short.append(s)
                keys.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(short, pa.bool_()), pa.array(keys, pa.list_(pa.int64()))], ["fp", "n", "mark", "short", "keys"])

    return asked.mapInArrow(read, "fp bigint, n bigint, mark bigint, short boolean, keys array<bigint>")


def index(docs: DataFrame, text_col: str, sets: DataFrame) -> DataFrame:
    """(key, fp, n, short): the keys of all distinct sets. ``sets``: fp, n, mark, shown."""
    shown = sets.select(F.explode("shown").alias("token"))
    frequent = stored(shown.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > LIST).select("token"), "frequent")
    state = stored(prefixes(sets, "shown", frequent), "keys")
    full = fetch(docs, text_col, state.filter("short is null").select("fp", "mark"), "full-sets").select("fp", _tokens("h").alias("t"))
    full = stored(full.select("fp", F.size("t").cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("mark"), "t"), "full-tokens")
    both = state.filter("short is not null").union(stored(prefixes(full, "t", frequent), "full-keys"))
    return both.select(F.explode("keys").alias("key"), "fp", "n", "short")


def _near(a: str, b: str) -> F.Column:
    """Sizes that allow a link."""
    return F.lit(100) * F.least(a, b) >= F.lit(PERCENT) * F.greatest(a, b)


def short_pairs(listed: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """(u, v), u > v: pairs of short lists that their shared keys do not rule out, and all of ``families`` with their hubs."""
    long_ones = (listed.filter(F.col("c") > LIST) if families is None else families).select("fp").distinct().withColumn("hot", F.lit(True))
    rows = listed.filter(F.col("c") <= LIST).join(_side(long_ones), "fp", "left")
    whole = rows.groupBy("key").agg(F.collect_list(F.struct("fp", "n", "short", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("l"))
    one = whole.select("l", F.posexplode("l").alias("i", "a"))
    two = one.select("a", F.explode(F.slice("l", F.col("i") + 2, LIST)).alias("b")).filter(_near("a.n", "b.n"))
    turned = F.col("a.fp") > F.col("b.fp")
    pairs = two.select(F.when(turned, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(turned, F.col("b")).otherwise(F.col("a")).alias("y"))
    pairs = pairs.select(F.col("x.fp").alias("u"), F.col("y.fp").alias("v"), "x", "y")
    if families is not None:
        pairs = pairs.unionByName(_ordered(families, "fp", "hub"), allowMissingColumns=True)
    one_each = [F.first("x", ignorenulls=True).alias("x"), F.first("y", ignorenulls=True).alias("y")]
    shared = pairs.groupBy("u", "v").agg(F.count("x").alias("shared"), F.bool_or(F.col("x").isNull()).alias("family"), *one_each)
    need = F.expr(f"({PERCENT} * (x.n + y.n) + {99 + PERCENT}) div {100 + PERCENT}")
    # tokens behind a prefix of rare tokens: s - (m + 1)
    behind = F.greatest(*[F.when(~F.col(f"{s}.short"), F.expr(f"({PERCENT} * {s}.n + 99) div 100 - 1")) for s in "xy"])
    open_ = (F.col("x.short") & F.col("y.short")) | (F.col("x.hot") & F.col("y.hot"))
    return shared.filter(F.col("family") | open_ | (F.col("shared") + behind >= need)).select("u", "v")


def hubs(listed: DataFrame) -> DataFrame:
    """Stored (fp, n, hub): the sets of long lists with the hubs that they meet, hubs themselves included."""
    rows = listed.filter(F.col("c") > LIST)
    met = rows.groupBy("fp").agg(F.sum("c").alias("met"))
    top = rows.join(met, "fp").groupBy("key").agg(F.max(F.struct("met", "fp")).alias("t")).select("key", F.col("t.fp").alias("hub"))
    return stored(rows.join(top, "key").select("fp", "n", "hub").distinct(), "families")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (u, v, more numbers) with both, either: sizes of the intersection and the union of each pair."""
    names = pairs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both, either = [], []
            for left, right in zip(b.column("a"), b.column("b")):
                x, y = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                z = np.sort(np.concatenate([x, y]), kind="stable")  # two runs: a merge
                n = int((z[1:] == z[:-1]).sum())
                both.append(n)
                either.append(len(z) - n)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(both, pa.int64()), pa.array(either, pa.int64())], [*names, "both", "either"])

    joined = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v").select(*names, "a", "b")
    return joined.mapInArrow(judge, ", ".join(f"{c} bigint" for c in [*names, "both", "either"]))


def _linked(found: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    return found.filter(F.lit(100) * F.col("both") >= F.lit(PERCENT) * F.col("either")).select(F.col(a).alias("u"), F.col(b).alias("v"))


def _ordered(df: DataFrame, a: str, b: str, *more: F.Column) -> DataFrame:
    return df.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), *more)


def differences(families: DataFrame, sets: DataFrame) -> DataFrame:
    """``families`` with (h, lacks, more, e): size of the hub, how many of its tokens a member lacks and how many others it has,
    and these tokens as numbers: lacking ones negative."""
    names = families.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = []
            for left, right in zip(b.column("a"), b.column("b")):
                hub, own = np.frombuffer(left.as_buffer(), "<u8"), np.frombuffer(right.as_buffer(), "<u8")
                lacks, more = (np.setdiff1d(x, y, assume_unique=True) >> U(1) for x, y in ((hub, own), (own, hub)))
                cells.append((len(hub), len(lacks), len(more), np.concatenate([-1 - lacks.astype(np.int64), more.astype(np.int64)])))
            cols = list(zip(*cells)) if cells else [()] * 4
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.list_(pa.int64()))], [*names, "h", "lacks", "more", "e"])

    joined = families.join(sets.toDF("hub", "a"), "hub").join(sets.toDF("fp", "b"), "fp").select(*names, "a", "b")
    return joined.mapInArrow(compare, ", ".join([*(f"{c} {t}" for c, t in families.dtypes), "h bigint, lacks bigint, more bigint, e array<bigint>"]))


def strays(families: DataFrame, found: DataFrame, stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, x, y): sets that are not of their hub's component with those members of the family that may be near them, and
    the roots of the two components, x > y.

    For members x and y of a hub of h tokens let g = 100 D + 80 A. A link needs (g_x + g_y - 20 h) / 180 common differences, more
    than none as g > 20 h for a set that is not linked to the hub. There are at most min(D_x, D_y) + min(A_x, A_y), and so
    at most D_y + A_y, from which 80 D_y + 100 A_y >= g_x - 20 h and g_y >= 0.8 (g_x - 20 h) follow.
    """
    p, all_ = PERCENT, 100 + PERCENT
    named = families.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp")).join(stars.toDF("hub", "hub_root"), "hub", "left")
    named = stored(named.withColumn("stray", F.col("root") != F.coalesce("hub_root", "hub")), "placed")
    open_ = named.join(named.filter("stray").select("hub").distinct(), "hub", "left_semi").filter("fp <> hub").select("hub", "fp", "n", "root", "stray")
    d = stored(differences(open_, sets), "differences").withColumn("g", 100 * F.col("lacks") + p * F.col("more")).withColumn("excess", F.col("g") - (100 - p) * F.col("h"))
    least = d.groupBy("hub").agg(F.min("g").alias("least"), F.min(F.when(F.col("stray"), F.col("g"))).alias("least_stray"))
    part = d.select("hub", "fp", F.explode("e").alias("e"))
    counted = part.join(part.groupBy("hub", "e").agg(F.count("*").alias("c")), ["hub", "e"])
    ranked = counted.groupBy("hub", "fp").agg(F.array_sort(F.collect_list(F.struct("c", "e"))).alias("r"))  # a set's own differences
    other = F.when(F.col("stray"), F.greatest(F.col("least"), F.col("excess") * p / 100)).otherwise(F.greatest("least_stray", F.col("excess") * p / 100))
    common = F.greatest(F.lit(1), F.ceil((F.col("excess") + other) / all_ - 1e-9))  # with any partner
    kept = d.drop("e").join(least, "hub").join(ranked, ["hub", "fp"]).withColumn("common", common).withColumn("k", (F.size("r") - F.col("common") + 1).cast("int")).filter("k > 0")
    rows = kept.select("hub", "fp", "n", "root", "stray", "lacks", "more", "excess", "g", F.size("r").alias("size"), F.posexplode(F.slice("r.e", F.lit(1), F.col("k"))).alias("place", "e"))
    rows = stored(rows, "difference-prefixes")
    s = rows.filter("stray").select("hub", "e", *[F.col(c).alias(f"s_{c}") for c in ("fp", "n", "root", "lacks", "more", "excess", "size", "place")])
    need = F.ceil((F.col("s_excess") + F.col("g")) / all_ - 1e-9)
    able = F.least("lacks", "s_lacks") + F.least("more", "s_more") >= need
    ahead = (F.col("place") + need <= F.col("size")) & (F.col("s_place") + need <= F.col("s_size"))  # in the prefixes that this pair needs
    cross = s.join(rows, ["hub", "e"]).filter((F.col("s_root") != F.col("root")) & _near("s_n", "n") & able & ahead & (~F.col("stray") | (F.col("s_fp") > F.col("fp"))))
    roots = F.greatest("s_root", "root").alias("x"), F.least("s_root", "root").alias("y")
    return _ordered(cross, "s_fp", "fp", *roots).distinct().join(found.select("u", "v"), ["u", "v"], "left_anti")


def rooted(docs: DataFrame, text_col: str, sets: DataFrame) -> DataFrame:
    """(fp, root): distinct sets with the smallest set that links of the full join connect them with, itself left out."""
    keys = index(docs, text_col, sets)
    lists = keys.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    listed = stored(keys.join(lists, "key"), "listed")
    families = hubs(listed)
    pairs = stored(short_pairs(listed, families), "pairs")
    asked = pairs.select("u").union(pairs.select("v")).toDF("fp")
    few = pairs.limit(BROADCAST // 2 + 1).count() <= BROADCAST // 2
    whole = fetch(docs, text_col, sets.select("fp", "mark").join(F.broadcast(asked) if few else asked.distinct(), "fp", "left_semi"), "pair-sets")
    found = stored(verified(pairs, whole), "found")
    stars = connected(_linked(found)).toDF("fp", "root")
    if families.isEmpty():
        return stars
    more = stored(strays(families, found, stars, whole), "strays")  # members of families are among the sets
    joined = connected(_linked(verified(more, whole), "x", "y").distinct()).toDF("root", "to")  # components, not sets
    return stars.join(joined, "root", "left").select("fp", F.coalesce("to", "root").alias("root")).union(joined)


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.monotonically_increasing_id().alias("place"), signed(F.col(text_col)).alias("s")).select("doc_id", "mark", "place", "s.*"), "signed")
    sets = stored(rows.filter("n > 0").groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("place").alias("place"), F.count("*").alias("rows")), "sets")
    copies = sets.filter("rows > 1").select("fp", F.col("place").alias("kept"))
    first = rows.filter("n > 0").join(_side(copies), "fp", "left").filter("kept is null or kept = place")  # one row of each set
    found = rooted(docs, text_col, first.select("fp", "n", "mark", "shown"))
    whole = sets.select("fp", "least").join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = whole.join(whole.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    out = rows.select("doc_id", "n", "fp").join(stored(named, "named"), "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
