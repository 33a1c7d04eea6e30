"""Event-store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import index as I
from ...session import scratch_path
from ...sources.store import Store
from .registry import query, view, view_sql, with_view


@query("ensure_timestamp", with_view("fw_scored", """select event_id, case when k%4=0 then '2024-02-01T00:00:00Z' else cast(ts as varchar) end as stamp from fw_scored"""))
def ensure_timestamp(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").withColumn("@timestamp", F.when(F.col("k") % 4 != 0, F.col("ts").cast("string")))
    return I.ensure_timestamp(e, now=F.lit("2024-02-01T00:00:00Z")).select("event_id", F.col("@timestamp").alias("stamp"))


@query("index_search", with_view("fw_scored", """select event_id, srcip, llm_confidence from fw_scored where llm_is_suspicious=1 and llm_response is not null
 and llm_confidence between 40 and 95 and srcip like '10.0.0.1%' order by llm_confidence desc, event_id limit 25"""))
def index_search(spark, sf_dir):
    hits = I.search(view(spark, sf_dir, "fw_scored"), terms={"llm_is_suspicious": 1}, range_=("llm_confidence", 40, 95), exists=("llm_response",),
                    wildcard={"srcip": "10.0.0.1*"}, sort=("llm_confidence", "desc", "event_id"), size=25)
    return hits.select("event_id", "srcip", "llm_confidence")


_STAMP = "substring(cast(ts as varchar), 1, 19)"


@query("document_id", with_view("fw_scored", f"select event_id, md5(concat(srcip, dstip, {_STAMP}, cast(srcport as varchar))) as doc_id from fw_scored"))
def document_id(spark, sf_dir):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return view(spark, sf_dir, "fw_scored").select("event_id", I.document_id(stamp).alias("doc_id"))


# Ids by address pair: many copies per id.
@query("dedup_documents", with_view("fw_scored", """select doc_id, event_id, dfp_score from (select *, md5(concat(srcip, dstip)) as doc_id from fw_scored) d
 qualify row_number() over (partition by doc_id order by ts desc, event_id desc) = 1"""))
def dedup_documents(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").withColumn("doc_id", F.md5(F.concat("srcip", "dstip")))
    return I.dedup_documents(e.select("doc_id", "ts", "event_id", "dfp_score")).select("doc_id", "event_id", "dfp_score")


_COND = "a.srcip=d.srcip and a.dstip=d.dstip and d.t between a.t-300 and a.t+300 and (a.srcport is null or a.srcport=d.srcport) and (a.dstport is null or a.dstport=d.dstport)"


def _asks_sql(body: str) -> str:
    best = f"""select a.ask_id, a.t, min(struct_pack(t := d.t, doc := d.doc_id)) as hit from asks a left join base_docs d on {_COND} group by a.ask_id, a.t"""
    return f"with asks as ({view_sql('asks', 'duckdb')}), base_docs as ({view_sql('base_docs', 'duckdb')}), best as ({best}) {body}"


def matched(spark, sf_dir):
    return I.match_enrichment(view(spark, sf_dir, "asks"), view(spark, sf_dir, "base_docs"))


@query("match_enrichment", _asks_sql("select ask_id, hit.doc as matched_doc, hit.t as matched_t from best"))
def match_enrichment(spark, sf_dir):
    return matched(spark, sf_dir).select("ask_id", "matched_doc", "matched_t")


@query("earliest_match", _asks_sql("select ask_id, hit.doc as matched_doc, hit.t as matched_t from best where hit.doc is not null"))
def earliest_match(spark, sf_dir):
    return I.earliest_match(matched(spark, sf_dir)).select("ask_id", "matched_doc", "matched_t")


# An ask whose stamp is no time cannot be processed: it is an error, matched or not.
_STAMP = "case when ask_id%9=0 then 'not a time' when ask_id%9=1 then '' else substring(cast(ts as string), 1, 19) end"


@query("match_stats", _asks_sql(f"""select count(*) as total, count_if(hit.doc is not null and not bad)::bigint as matched, count_if(hit.doc is null and not bad)::bigint as no_match,
 count_if(bad)::bigint as errors from best join (select ask_id, try_cast({_STAMP} as timestamp) is null as bad from asks) s using (ask_id)"""))
def match_stats(spark, sf_dir):
    stamps = view(spark, sf_dir, "asks").select("ask_id", F.expr(_STAMP).try_cast("timestamp").isNull().alias("bad"))
    return I.match_stats(matched(spark, sf_dir).join(stamps, "ask_id"), F.col("bad"))


# Documents whose address was stored with a suffix match only by the substring search.
_SUFFIXED = "select doc_id, t, concat(srcip, ' ') as srcip, dstip, srcport, dstport from base_docs"


@query("wildcard_diagnose", f"""with asks as ({view_sql('asks', 'duckdb')}), base_docs as ({view_sql('base_docs', 'duckdb')}), docs as ({_SUFFIXED}),
 few as (select ask_id, srcip, dstip, t from asks order by t, ask_id limit 10)
 select f.ask_id, count(d.doc_id) as hits from few f left join docs d on contains(d.srcip, f.srcip) and contains(d.dstip, f.dstip) and d.t between f.t-300 and f.t+300 group by f.ask_id""")
def wildcard_diagnose(spark, sf_dir):
    asks = view(spark, sf_dir, "asks")
    docs = view(spark, sf_dir, "base_docs").withColumn("srcip", F.concat("srcip", F.lit(" ")))
    found = I.match_enrichment(asks, docs)
    return I.wildcard_diagnose(asks.join(found.filter("matched_doc is null"), "ask_id", "left_semi"), docs)


_LOOSE = """select event_id, case when k%5=0 then '' when k%5=1 then 'not a time' else replace(substring(cast(ts as string), 1, 19), ' ', 'T') end as stamp,
 case when k%7=0 then '' when k%7=1 then null else srcip end as srcip, dstip from fw_scored"""


@query("require_keys", with_view("fw_scored", f"""select event_id, case when stamp='' or coalesce(srcip, '')='' then 'missing_key' when try_cast(stamp as timestamp) is null then 'bad_timestamp'
 else 'ok' end as outcome from ({_LOOSE}) l"""))
def require_keys(spark, sf_dir):
    e = spark.sql(_LOOSE.replace("fw_scored", "{fw_scored}"), fw_scored=view(spark, sf_dir, "fw_scored"))
    good, bad = I.require_keys(e, "stamp")
    return good.select("event_id", F.lit("ok").alias("outcome")).unionByName(bad.select("event_id", F.col("skip_reason").alias("outcome")))


_OLD = "select doc_id, t, srcip, case when doc_id%3=0 then 1 end as llm_is_suspicious, case when doc_id%3=0 then 99 end::bigint as llm_confidence, case when doc_id%3=0 then 'earlier' end as llm_response, cast(null as varchar) as llm_trigger from base_docs"


def _merge_sql(policy: str) -> str:
    value = lambda f: f"case when w.doc is not null then {'w.' + f if policy == 'overwrite' else f'coalesce(w.{f}, o.{f})'} else o.{f} end as {f}"
    return _asks_sql(f""", win as (select hit.doc as doc, a.llm_is_suspicious, a.llm_confidence, a.llm_response, a.llm_trigger from best b join asks a using (ask_id)
 where hit.doc is not null qualify row_number() over (partition by hit.doc order by a.t desc, a.ask_id desc) = 1)
 select o.doc_id, {", ".join(value(f) for f in I.MERGED)}, w.doc is not null as llm_matched from ({_OLD}) o left join win w on w.doc = o.doc_id""")


def _merge(spark, sf_dir, policy: str):
    asks = view(spark, sf_dir, "asks")
    docs = view(spark, sf_dir, "base_docs")
    third = F.col("doc_id") % 3 == 0
    docs = docs.withColumns({
        "llm_is_suspicious": F.when(third, 1), "llm_confidence": F.when(third, F.lit(99).cast("bigint")),
        "llm_response": F.when(third, "earlier"), "llm_trigger": F.lit(None).cast("string")})
    results = I.match_enrichment(asks, docs).join(asks, "ask_id")
    return I.merge_enrichment(docs, results, null_policy=policy).select("doc_id", *I.MERGED, "llm_matched")


@query("merge_stored", _merge_sql("overwrite"))
def merge_stored(spark, sf_dir):
    """Documents are stored by day, the merge writes the touched days, and the store is read again."""
    asks, docs = view(spark, sf_dir, "asks"), view(spark, sf_dir, "base_docs")
    third = F.col("doc_id") % 3 == 0
    docs = docs.withColumns({
        "llm_is_suspicious": F.when(third, 1), "llm_confidence": F.when(third, F.lit(99).cast("bigint")),
        "llm_response": F.when(third, "earlier"), "llm_trigger": F.lit(None).cast("string"), "llm_matched": F.lit(False)})
    store = Store(spark, scratch_path(spark, "events"), docs.schema, F.to_date(F.timestamp_seconds("t")))
    store.append(docs, "load")
    stored = store.read()
    I.merge_stored(store, I.match_enrichment(asks, stored).join(asks, "ask_id"), "merge")
    return store.read().select("doc_id", *I.MERGED, "llm_matched")


@query("merge_enrichment", _merge_sql("overwrite"))
def merge_enrichment(spark, sf_dir):
    return _merge(spark, sf_dir, "overwrite")


@query("merge_enrichment_keep", _merge_sql("keep"))
def merge_enrichment_keep(spark, sf_dir):
    return _merge(spark, sf_dir, "keep")
