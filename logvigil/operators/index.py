"""Stored-event maintenance: ids, deduplication, matching of late results and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.bloom import MAX_BYTES, build_filter
from ..sources.store import Store


def ensure_timestamp(df: DataFrame, col: str = "@timestamp", now: Column | None = None) -> DataFrame:
    """Fill a missing time with ``now`` (text, default the current UTC time with a ``Z``)."""
    if now is None:
        now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    have = F.col(f"`{col}`") if col in df.columns else F.lit(None).cast("string")
    return df.withColumn(col, F.coalesce(have, now))


def search(
    df: DataFrame,
    terms: dict | None = None,
    range_: tuple | None = None,
    exists: tuple[str, ...] = (),
    wildcard: dict[str, str] | None = None,
    sort: tuple | None = None,
    size: int | None = None,
) -> DataFrame:
    """All conditions must hold: equality, ``(column, low, high)`` range, presence, ``*`` patterns.

    ``sort`` is (column, "asc" | "desc", ...tie columns). With ``size`` it runs as a distributed
    top-k. Equality and range conditions reach the parquet scan.
    """
    out = df
    for name, value in (terms or {}).items():
        out = out.filter(F.col(name) == F.lit(value))
    if range_:
        name, low, high = range_
        out = out.filter(F.col(name).between(low, high))
    for name in exists:
        out = out.filter(F.col(name).isNotNull())
    for name, pattern in (wildcard or {}).items():
        like = pattern.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%").replace("?", "_")
        out = out.filter(F.col(name).like(like))
    if sort:
        name, way, *ties = sort
        out = out.orderBy(F.desc(name) if way == "desc" else F.asc(name), *ties)
    return out if size is None else out.limit(size)


def document_id(ts: Column, srcip: str = "srcip", dstip: str = "dstip", srcport: str = "srcport") -> Column:
    """32 hex characters from source, destination, time (text) and source port."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(part(F.col(srcip)), part(F.col(dstip)), part(ts), part(F.col(srcport))))


def dedup_documents(df: DataFrame, key: str = "doc_id", order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The newest document of every id.

    The row-number filter is applied per map task before the shuffle, so a document with very many
    copies sends one row per task.
    """
    newest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def require_keys(df: DataFrame, ts: str = "@timestamp", keys: tuple[str, ...] = ("srcip", "dstip")) -> tuple[DataFrame, DataFrame]:
    """(usable rows with ``match_ts``, skipped rows with ``skip_reason``)."""
    stamp = F.col(f"`{ts}`").cast("string")
    missing = stamp.isNull() | (stamp == "")
    for k in keys:
        missing = missing | F.col(k).isNull() | (F.col(k).cast("string") == "")
    out = df.withColumn("match_ts", stamp.try_cast("timestamp")).withColumn(
        "skip_reason", F.when(missing, "missing_key").when(F.col("match_ts").isNull(), "bad_timestamp"))
    return out.filter("skip_reason is null").drop("skip_reason"), out.filter("skip_reason is not null").drop("match_ts")


def _join_keys(df: DataFrame, ports: list[str], mask: Column) -> list[Column]:
    """Join columns of one row: the two addresses, which ports take part, and their values."""
    cols = [F.col("srcip").alias("_src"), F.col("dstip").alias("_dst"), mask.alias("_mask")]
    for i, p in enumerate(ports):
        used = mask.bitwiseAND(F.lit(1 << i)) != 0
        cols.append(F.when(used, F.col(p).try_cast("bigint")).alias(f"_p{i}"))
    return cols


def near_asks(docs: DataFrame, asks: DataFrame, clock: str = "t", seconds: int = C.MATCH_SECONDS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The documents whose addresses and time slot some ask could match, and about one in a hundred others.

    The asks are copied to the two slots that their window touches and fill a Bloom filter, which the documents meet inside
    their scan: what is left of them is shuffled. Asks too many for ``max_bytes`` prune nothing.
    """
    width = 2 * seconds
    slot = lambda c: F.expr(f"({c} - pmod({c}, {width})) div {width}")
    ticks = asks.select("srcip", "dstip", F.col(clock).cast("bigint").alias("_t")).withColumns({"_lo": F.col("_t") - seconds, "_hi": F.col("_t") + seconds})
    keys = ticks.select("srcip", "dstip", F.explode(F.array(slot("_lo"), slot("_hi"))).alias("_slot"))
    near = build_filter(keys, 2 * asks.count(), max_bytes)
    if near is None:
        return docs
    at = F.col(clock).cast("bigint")
    return docs.filter(near([F.col("srcip"), F.col("dstip"), F.expr(f"(cast({clock} as bigint) - pmod(cast({clock} as bigint), {width})) div {width}")]) | at.isNull())


def match_enrichment(asks: DataFrame, docs: DataFrame, ask_id: str = "ask_id", doc_id: str = "doc_id", clock: str = "t", seconds: int = C.MATCH_SECONDS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """For every ask the earliest document of the same addresses within +-``seconds``; ports must
    agree where the ask carries them. Adds ``matched_doc`` and ``matched_t`` (null: no match).

    ``clock`` is an integer column. This is a forward as-of search, not a join of all pairs: both
    sides are reduced to distinct (key, tick) first, each tick of an ask looks for the first
    document tick at or after ``tick - seconds``, and the answer is joined back. Work is cut by
    key and time slot, so a busy address pair is spread over its slots and holds at most one row
    per tick in each. Documents far from all asks are left out first, see ``near_asks``.
    """
    docs = near_asks(docs, asks, clock, seconds, max_bytes)
    ports = [p for p in ("srcport", "dstport") if p in asks.columns and p in docs.columns]
    if ports:
        mask = F.lit(0)
        for i, p in enumerate(ports):
            mask = mask + F.when(F.col(p).isNotNull(), 1 << i).otherwise(0)
        # documents are offered once per combination of ports that some ask uses, at most 2^ports
        used = sorted(r[0] for r in asks.select(mask).distinct().collect())
        spread = docs.withColumn("_m", F.explode(F.array(*[F.lit(i) for i in used or [0]])))
        dmask = F.col("_m")
    else:
        mask, dmask, spread = F.lit(0), F.lit(0), docs
    keys = ["_src", "_dst", "_mask", *[f"_p{i}" for i in range(len(ports))]]
    width = 2 * seconds
    slot = lambda c: F.expr(f"({c} - pmod({c}, {width})) div {width}")
    asked = asks.select(F.col(ask_id).alias("_ask"), F.col(clock).cast("bigint").alias("_t"), *_join_keys(asks, ports, mask))
    offer = spread.select(F.col(doc_id).alias("_doc"), F.col(clock).cast("bigint").alias("_at"), *_join_keys(spread, ports, dmask))

    want = asked.select(*keys, "_t").distinct().withColumn("_at", F.col("_t") - seconds)
    have = offer.groupBy(*keys, "_at").agg(F.min("_doc").alias("_doc"))
    # A search can reach into the next slot, so documents are offered to their own slot and the one before.
    have = have.withColumn("_slot", F.explode(F.array(slot("_at"), slot("_at") - 1)))
    none = F.lit(None).cast
    lanes = have.select(*keys, "_slot", "_at", F.struct("_at", "_doc").alias("_offer"), none("bigint").alias("_t")).unionByName(
        want.withColumn("_slot", slot("_at")).select(*keys, "_slot", "_at", none(f"struct<_at:bigint,_doc:{dict(docs.dtypes)[doc_id]}>").alias("_offer"), "_t"))
    # Newest first, so the running last value is the first document at or after the search time;
    # at equal times the document comes before the search.
    order = Window.partitionBy(*keys, "_slot").orderBy(F.desc("_at"), F.asc(F.when(F.col("_t").isNull(), 0).otherwise(1)))
    found = lanes.withColumn("_hit", F.last("_offer", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.filter(F.col("_t").isNotNull()).filter(F.col("_hit._at") <= F.col("_t") + seconds)
    found = found.select(*keys, "_t", F.col("_hit._doc").alias("matched_doc"), F.col("_hit._at").alias("matched_t"))

    both = [F.col(f"a.{k}").eqNullSafe(F.col(f"f.{k}")) for k in [*keys, "_t"]]
    cond = both[0]
    for c in both[1:]:
        cond = cond & c
    best = asked.alias("a").join(found.alias("f"), cond, "left").select("a._ask", "f.matched_doc", "f.matched_t")
    return best.withColumnRenamed("_ask", ask_id)


def earliest_match(matches: DataFrame) -> DataFrame:
    """Only the asks that found a document."""
    return matches.filter(F.col("matched_doc").isNotNull())


def wildcard_diagnose(unmatched: DataFrame, docs: DataFrame, ask_id: str = "ask_id", clock: str = "t", seconds: int = C.MATCH_SECONDS, first: int = 10) -> DataFrame:
    """Diagnosis of the first ``first`` unmatched asks: documents in the time window whose addresses
    contain the asked ones. The limit is part of the report; nothing is updated."""
    few = unmatched.orderBy(clock, ask_id).limit(first).select(
        F.col(ask_id).alias("_ask"), F.col("srcip").alias("_src"), F.col("dstip").alias("_dst"), F.col(clock).alias("_t"))
    # an ask's window touches at most two time slots; the slot is the join key
    width = 2 * seconds
    slot = lambda c: F.expr(f"({c} - pmod({c}, {width})) div {width}")
    windows = few.withColumn("_from", F.col("_t") - seconds).withColumn("_slot", F.explode(F.array(slot("_from"), slot("_from") + 1)))
    like = (
        F.col(clock).between(F.col("_t") - seconds, F.col("_t") + seconds)
        & F.contains(F.col("srcip"), F.col("_src")) & F.contains(F.col("dstip"), F.col("_dst"))
    )
    near = docs.select("srcip", "dstip", clock).withColumn("_slot", slot(clock))
    hits = near.join(F.broadcast(windows), "_slot").filter(like).groupBy("_ask").agg(F.count("*").alias("hits"))
    return few.join(hits, "_ask", "left").select(F.col("_ask").alias(ask_id), F.coalesce("hits", F.lit(0)).alias("hits"))


MERGED = ("llm_is_suspicious", "llm_confidence", "llm_response", "llm_trigger")


def merge_enrichment(docs: DataFrame, results: DataFrame, doc_id: str = "doc_id", order: tuple[str, ...] = ("t", "ask_id"), null_policy: str = "overwrite", fields: tuple[str, ...] = MERGED) -> DataFrame:
    """Write result fields into the matched documents and set ``llm_matched``.

    ``results`` has ``matched_doc``. The last result of a document wins. Missing values overwrite
    with null (``"overwrite"``) or leave the old value (``"keep"``).
    """
    newest = dedup_documents(results.filter(F.col("matched_doc").isNotNull()), "matched_doc", order)
    new = newest.select(F.col("matched_doc").alias(doc_id), *[F.col(f).alias(f"_new_{f}") for f in fields], F.lit(True).alias("_hit"))
    joined = docs.join(new, doc_id, "left")
    hit = F.coalesce("_hit", F.lit(False))

    def value(f: str) -> Column:
        old = F.col(f) if f in docs.columns else F.lit(None)
        fresh = F.col(f"_new_{f}") if null_policy == "overwrite" else F.coalesce(F.col(f"_new_{f}"), old)
        return F.when(hit, fresh).otherwise(old)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (*fields, "llm_matched")]
    before = F.coalesce("llm_matched", F.lit(False)) if "llm_matched" in docs.columns else F.lit(False)
    return joined.select(*kept, *[value(f).alias(f) for f in fields], (hit | before).alias("llm_matched"))


def merge_stored(store: Store, results: DataFrame, txn: str, doc_id: str = "doc_id", order: tuple[str, ...] = ("t", "ask_id"), null_policy: str = "overwrite", fields: tuple[str, ...] = MERGED) -> list[tuple[str, str]]:
    """``merge_enrichment`` into a stored table: only the parts that hold a matched document are read whole, written anew and
    published in one commit. Returns these (folder, part). The store's columns must include the fields and ``llm_matched``."""
    matched = results.filter(F.col("matched_doc").isNotNull())
    cells = store.touched(matched.select(F.col("matched_doc").alias(doc_id)), doc_id)
    store.rewrite(cells, lambda docs: merge_enrichment(docs, matched, doc_id, order, null_policy, fields), txn)
    return cells


def match_stats(matches: DataFrame, errors: Column | None = None) -> DataFrame:
    """total, matched, no_match and errors in one row."""
    bad = F.lit(False) if errors is None else F.coalesce(errors, F.lit(False))
    hit = F.col("matched_doc").isNotNull()
    return matches.agg(
        F.count("*").alias("total"), F.count_if(hit & ~bad).alias("matched"),
        F.count_if(~hit & ~bad).alias("no_match"), F.count_if(bad).alias("errors"),
    )
