"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, fim_chunks, jaccard_join, lang_mixture, lm_bloom, pu_quality, separator_scan, simhash_cover, source_mix, token_alignment, token_shards, url_cascade, vptree
from .common import table

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@query("op4_url_cascade", url_cascade.URL_SQL)
def op4(spark, sf_dir):
    rules = spark.sql(f"select * from values {', '.join(map(str, url_cascade.RULES))} as r(host, path, verdict)")
    return url_cascade.judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query("op5_decontaminate", decontaminate.LEAK_SQL)
def op5(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_source_mix", source_mix.MIX_SQL)
def op9(spark, sf_dir):
    return source_mix.mix_report(table(spark, sf_dir, "documents"))


@query("op1_token_shards")
def op1(spark, sf_dir):
    return token_shards.shards(table(spark, sf_dir, "documents"))


@query("op2_separator_scan")
def op2(spark, sf_dir):
    return separator_scan.corpus_counts(table(spark, sf_dir, "documents"))


@query("op3_simhash_cover")
def op3(spark, sf_dir):
    return simhash_cover.components(table(spark, sf_dir, "documents"))


@query("op6_pu_quality")
def op6(spark, sf_dir):
    return pu_quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_vptree")
def op7(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vptree.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op8_lang_mixture")
def op8(spark, sf_dir):
    return lang_mixture.identify(table(spark, sf_dir, "documents"))


@query("op10_lm_bloom")
def op10(spark, sf_dir):
    return lm_bloom.scores(table(spark, sf_dir, "documents"))


@query("op11_fim_chunks", fim_chunks.FIM_SQL)
def op11(spark, sf_dir):
    return fim_chunks.report(table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return token_alignment.report(table(spark, sf_dir, "documents"))


@query("op13_jaccard_join")
def op13(spark, sf_dir):
    return jaccard_join.components(table(spark, sf_dir, "documents"))
