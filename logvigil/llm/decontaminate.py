"""Benchmark decontamination with a broadcast hash set of normalised windows, in built-in functions only.

A benchmark item gives its windows of ``width`` consecutive words (an item of fewer words is one window). The distinct
windows form a hash set: a table of 2^b buckets, each the windows that fall into it with the numbers of their items. It
is one literal of the plan, sent to each task, and bounded by ``max_bytes``; a larger benchmark is worked in blocks of
windows, one pass over the documents for each, with the hits so far kept in a stored table. A document is scanned inside
its own row: window hashes find non-empty buckets, the window's words verify the hit. Nothing is shuffled but the
benchmark, so neither hot sources nor copies nor frequent passages matter.

Words are ASCII digits, ASCII letters (A-Z lower-cased) and everything beyond ASCII. Null text and text without words
have no windows; null item texts and items without words have none either; a null item_id counts as the empty text.
Repeated documents get equal results; repeated items are one. Columns named like results are replaced, others kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: Fixed value: what stands between words, on lower-cased text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_BYTES = 8 << 20


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _hash(word_hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.slice(word_hashes, at, width))


def _starts(ws: Column, width: int) -> Column:
    """Start positions (from 1) of all windows; none if the text is shorter."""
    return F.when(F.size(ws) >= width, F.sequence(F.lit(1), F.size(ws) - (width - 1))).otherwise(F.array().cast("array<int>"))


def windows(benchmark: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (width, window, h, items): the words joined by blanks, their hash, and the ids that have it."""
    split = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w")).filter("size(w) > 0").distinct()
    n = F.least(F.size("w"), F.lit(width))
    # not _starts: the width is the item's own
    at = split.select("item", "w", n.alias("width"), F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at"))
    cut = at.select("item", "width", F.slice("w", F.col("at"), F.col("width")).alias("w"))
    one = cut.select("item", "width", F.array_join("w", " ").alias("window"), F.xxhash64(F.transform("w", lambda x: F.xxhash64(x))).alias("h"))
    return one.groupBy("width", "window", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _table(rows: list, buckets: int) -> Column:
    """The hash set as one array literal: bucket text = newline, window, tab, ids divided by \\x01, newline, ..."""
    cells = [""] * buckets
    for r in rows:
        i = r.h & (buckets - 1)
        cells[i] = (cells[i] or "\n") + r.window + "\t" + "\x01".join(r["items"]) + "\n"
    return F.split(F.lit("\x02".join(cells)), "\x02")  # folded once; neither mark is a word character


def _hits(ws: Column, hs: Column, table: Column, buckets: int, width: int) -> Column:
    def cell(at: Column) -> Column:
        return F.get(table, _hash(hs, at, width).bitwiseAND(F.lit(buckets - 1)).cast("int"))

    def verified(at: Column) -> Column:
        key = F.concat(F.lit("\n"), F.array_join(F.slice(ws, at, width), " "), F.lit("\t"))
        bucket = cell(at)
        ids = F.when(F.contains(bucket, key), F.substring_index(F.call_function("substring_index", bucket, key, F.lit(-1)), "\n", 1))
        return F.struct(at.alias("at"), F.lit(width).alias("width"), ids.alias("items"))

    near = F.filter(_starts(ws, width), lambda at: cell(at) != "")
    return F.filter(F.transform(near, verified), lambda h: h["items"].isNotNull())


def mark(docs: DataFrame, benchmark: DataFrame, width: int = 10, text_col: str = "text", max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (sorted array of at, width, items) for every document."""
    found = stored(windows(benchmark, width), "windows")
    size = found.agg(F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", " ")) + 4), F.count("*")).first()
    blocks = max(1, math.ceil((size[0] or 0) / max_bytes), math.ceil(size[1] * 8 / max_bytes))
    kind = "array<struct<at:int,width:int,items:string>>"
    out = docs.drop("hits", "n_words").withColumn("hits", F.array().cast(kind))
    for b in range(blocks):
        rows = found.filter(F.pmod(F.hash("window"), F.lit(blocks)) == b).collect()  # at most about max_bytes
        buckets = 1 << max(4, (8 * len(rows) - 1).bit_length())
        table, widths = _table(rows, buckets), sorted({r.width for r in rows})

        def scan(ws: Column) -> Column:
            return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda hs: F.struct(
                F.size(ws).cast("bigint").alias("n_words"),
                (F.flatten(F.array(*[_hits(ws, hs, table, buckets, n) for n in widths])) if widths else F.array()).cast(kind).alias("new")))

        got = out.withColumn("_scan", let(words(F.col(text_col)), scan))
        out = got.withColumns({"n_words": F.col("_scan.n_words"), "hits": F.array_sort(F.concat("hits", "_scan.new"))}).drop("_scan")
        if b + 1 < blocks:
            out = stored(out, "hits")
    return out


def hit_words(hits: Column) -> Column:
    """Words inside any hit: length of the union of the windows, which come sorted by start."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def step(acc: Column, h: Column) -> Column:
        end = h["at"] + h["width"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], h["at"]))).alias("n"))

    return F.aggregate(hits, start, step, lambda acc: acc["n"])


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    got = mark(docs.select("doc_id", "text"), benchmark, **how).select("doc_id", "n_words", F.struct("hits").alias("s"))
    ids = let(F.array_sort(F.array_distinct(F.flatten(F.transform(F.col("s.hits"), lambda h: F.split(h["items"], "\x01"))))), lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_items"), F.sha2(F.array_join(x, ","), 256).alias("items_sha256")))
    flat = got.select("doc_id", "n_words", hit_words(F.col("s.hits")).alias("n_hit"), ids.alias("i"))
    return flat.select("doc_id", "n_words", "n_hit", "i.n_items", "i.items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, spans: bool = False, **how) -> DataFrame:
    """The columns of ``docs`` without contaminated documents or, with ``spans``, with the hit words (and what
    separates them from the next) cut out of the text."""
    packed = mark(docs.select(F.struct("*").alias("_row"), "text"), benchmark, **how)
    if not spans:
        return packed.filter("size(hits) = 0").select("_row.*")
    piece = r"(?s)[0-9A-Za-z\u0080-\x{10FFFF}]+[^0-9A-Za-z\u0080-\x{10FFFF}]*"
    head = F.regexp_extract("text", r"(?s)^[^0-9A-Za-z\u0080-\x{10FFFF}]*", 0)
    left = F.filter(F.regexp_extract_all("text", F.lit(piece), F.lit(0)), lambda x, i: ~F.exists("hits", lambda h: (i + 1 >= h["at"]) & (i + 1 < h["at"] + h["width"])))
    text = F.when(F.size("hits") == 0, F.col("text")).otherwise(F.concat(head, F.array_join(left, "")))
    return packed.withColumn("_text", text).select(*[F.col("_text").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


LEAK_SQL = r"""with lower_docs as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
d as (select row_number() over () as row, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lower_docs),
i as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
il as (select item_id, w, least(len(w), 10) as n from i where len(w) > 0),
iw as (select distinct item_id, n, array_to_string(w[k:k + n - 1], ' ') as win from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as k from il)),
dw as (select row, doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as win from (select row, doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, (select distinct n from il) where len(w) >= n)),
h as (select row, k, iw.n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n),
hw as (select row, count(distinct p) as n_hit from (select row, unnest(range(k, k + n)) as p from h) group by row),
hi as (select row, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from h group by row)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hw using (row) left join hi using (row)"""
