"""Counter and evaluation queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import constants as C
from ...operators import metrics as M
from ...operators import peers as PE
from .. import dfp
from ..views import table
from .profile import _GROUP_SQL, GROUPS, _scored, _seq, dfp_sql, portable_groups
from .registry import query, view, view_sql, with_view


@query("dfp_metrics", _seq(f"""select count(distinct dfp_entity) as total_entities, count(distinct case when dfp_status='trained' then dfp_entity end) as trained_models,
 sum(dfp_is_anomaly)::bigint as anomalies_detected, count(distinct dfp_entity) as profiles_created, count(*) as messages_processed, count(distinct dfp_peer_group_id) as peer_groups,
 sum(dfp_is_anomaly)::bigint as peer_anomalies_detected, count(*) // 100 as peer_grouping_runs from ({dfp_sql(True)}) d"""))
def dfp_metrics(spark, sf_dir):
    return M.dfp_metrics(_scored(spark, sf_dir, peers=True))


# Ten entities of which five are admitted; those have a group once a row of theirs is scored.
@query("top_entities", with_view("fw", f"""select entity as dfp_entity, messages, case when kept then 'profiled' else 'tracking' end as status,
 case when kept and messages >= 24 then cast({_GROUP_SQL} as varchar) else 'ungrouped' end as peer_group from (select srcip as entity, count(*) as messages,
 row_number() over (order by count(*) desc, srcip) <= 5 and (count(*) over () <= 5 or count(*) >= {C.MIN_ENTITY_ROWS}) as kept from fw group by 1) e
 order by messages desc, entity limit 10"""))
def top_entities(spark, sf_dir):
    e = view(spark, sf_dir, "fw")
    groups = portable_groups(e.withColumnRenamed("srcip", "entity"))
    return M.top_entities(dfp.score_admitted(e, 5, clock=F.col("ts"), assignments=groups), 10)


# Two groups more than have members: they count in the average.
@query("group_sizes", with_view("fw", f"""select group_id, n as members, round(sum(n) over () / {GROUPS + 2}.0, 6) as avg_members from (select {_GROUP_SQL} as group_id, count(*) as n
 from (select distinct srcip as entity from fw) e group by 1) g"""))
def group_sizes(spark, sf_dir):
    g = PE.group_sizes(portable_groups(view(spark, sf_dir, "fw").withColumnRenamed("srcip", "entity")), GROUPS + 2)
    return g.select("group_id", "members", F.round("avg_members", 6).alias("avg_members"))


@query("throughput", "select cast(time_bucket(interval '1 minute', ts) as varchar) as window_start, count(*) as messages from events group by 1")
def throughput(spark, sf_dir):
    return M.throughput(table(spark, sf_dir, "events")).select(F.col("window_start").cast("string").alias("window_start"), "messages")


@query("class_distribution", with_view("fw_scored", "select threat_class, count(*) as n from fw_scored group by 1"))
def class_distribution(spark, sf_dir):
    return M.class_distribution(view(spark, sf_dir, "fw_scored"))


_EVAL = "select l.quality as label, case when d.n_chars > 500 then 1 else 0 end as prediction from labels l join documents d using (doc_id)"


@query("evaluate_classifier", f"""with e as ({_EVAL}), c as (select x as cls, (select count(*) from e where label=x) as actual, (select count(*) from e where prediction=x) as called,
 (select count(*) from e where label=x and prediction=x) as tp from (select distinct label as x from e union select distinct prediction from e) u)
 select sum(actual)::bigint as total, round(sum(tp)/sum(actual), 6) as accuracy,
 round(sum(actual * case when actual+called > 0 then 2.0*tp/(actual+called) else 0.0 end)/sum(actual), 6) as f1 from c""")
def evaluate_classifier(spark, sf_dir):
    # the quality labels judge a length classifier
    e = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    e = e.select(F.col("quality").alias("label"), F.when(F.col("n_chars") > 500, 1).otherwise(0).alias("prediction"))
    return M.evaluate_classifier(e).select("total", F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query("prepare_training_set", with_view("fw_scored", """select event_id, threat_class, case when substring(md5(cast(event_id as varchar)), 1, 2) < '33' then 'validation' else 'train' end as split
 from fw_scored qualify threat_class='normal' or row_number() over (partition by threat_class order by md5(cast(event_id as varchar)), event_id) <= 500"""))
def prepare_training_set(spark, sf_dir):
    e = view(spark, sf_dir, "fw_scored").select("event_id", "threat_class")
    return M.prepare_training_set(e, "threat_class", "event_id", cap=500)


def _size_sql(cols: list[tuple[str, bool]]) -> str:
    """Length of the JSON object: braces, commas, quoted names, values (text in quotes)."""
    fixed = 2 + len(cols) - 1 + sum(len(c) + 3 for c, _ in cols)
    return f"{fixed} + " + " + ".join(f"strlen(cast({c} as varchar)){' + 2' if text else ''}" for c, text in cols)


_STAGES = {
    "raw": [("value", True)],
    "parsed": [("event_id", False), ("srcip", True), ("dstip", True), ("srcport", False), ("dstport", False), ("proto", False), ("action", True), ("app", True), ("rcvdbyte", False), ("duration", False)],
    "scored": [("event_id", False), ("srcip", True), ("dstip", True), ("dfp_is_anomaly", False), ("threat_class", True)],
    "reviewed": [("event_id", False), ("srcip", True), ("dstip", True), ("dfp_is_anomaly", False), ("threat_class", True), ("llm_status", True), ("llm_is_suspicious", False),
                 ("llm_confidence", False), ("llm_trigger", True)],
}


def _raw_size(value: str) -> str:
    # quotes inside the line are escaped
    return f"{len(chr(123) + chr(34) + 'value' + chr(34) + ':' + chr(125)) + 2} + strlen({value}) + (strlen({value}) - strlen(replace({value}, chr(34), '')))"


@query("message_size", with_view("fw_scored", f"select 'scored' as stage, round(avg({_size_sql(_STAGES['scored'])}), 4) as bytes from fw_scored union all "
       f"select 'reviewed', round(avg({_size_sql(_STAGES['reviewed'])}), 4) from fw_scored union all select 'parsed', round(avg({_size_sql(_STAGES['parsed'])}), 4) from ({view_sql('fw', 'duckdb')}) p union all select 'raw', round(avg({_raw_size('value')}), 4) from ({view_sql('raw_lines', 'duckdb')}) r"))
def message_size(spark, sf_dir):
    sizes = []
    for stage, name in (("raw", "raw_lines"), ("parsed", "fw"), ("scored", "fw_scored"), ("reviewed", "fw_scored")):
        e = view(spark, sf_dir, name)
        sizes.append(e.agg(F.round(M.message_size(e, [c for c, _ in _STAGES[stage]]), 4).alias("bytes")).select(F.lit(stage).alias("stage"), "bytes"))
    return reduce(DataFrame.unionByName, sizes)


@query("documents_per_day_all", with_view("fw_scored", "select cast(cast(ts as date) as varchar) as day, count(*) as documents from fw_scored group by 1"))
def documents_per_day_all(spark, sf_dir):
    return M.documents_per_day(view(spark, sf_dir, "fw_scored")).select(F.col("day").cast("string").alias("day"), "documents")


@query("documents_per_day", with_view("fw_scored", "select cast(cast(ts as date) as varchar) as day, count(*) as documents from fw_scored where ts >= timestamp '2024-01-11' group by 1"))
def documents_per_day(spark, sf_dir):
    d = M.documents_per_day(view(spark, sf_dir, "fw_scored"), keep_days=30, today=F.lit("2024-02-10").cast("date"))
    return d.select(F.col("day").cast("string").alias("day"), "documents")


