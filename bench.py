"""Headline queries, planning included, after a warm-up on the smallest scale, on local[$BENCH_CPUS] over $BENCH_SF_DIR. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logvigil.plans.catalog import QUERIES  # noqa: E402
from logvigil.session import build_session  # noqa: E402

HEADLINE = [
    "dfp_score", "dfp_score_individual", "signature_match", "signature_documents", "cooldown_gate", "review_status", "match_enrichment",
    "merge_enrichment", "frequency_rule", "evaluate_rules", "feature_block_bulk", "normalize_types", "cascade", "peer_stats", "dedup_documents", "dfp_score_stream",
]
ROWS = {"feature_block_bulk": "lineitem", "signature_documents": "documents"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start the executors
    only = sys.argv[1:] or HEADLINE
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):  # compile and load classes on a small input; results are not kept
        for name in only:
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("events", "lineitem", "documents")}
    times: dict[str, float] = {}
    for name in only:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    rate = {n: round(sizes[ROWS.get(n, "events")] / s) for n, s in times.items()}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "rows_per_sec": rate, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
