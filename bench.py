"""Times the headline queries once each and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from bandsieve.plans import corpora
from bandsieve.queries import QUERIES
from bandsieve.session import local_session

HEADLINE = (
    "funnel_totals", "funnel_by_layer", "funnel_custom_bands", "verdict_per_clip", "decide_per_stage", "status_matrix", "stage_confirm_rate", "episodes_list", "bad_list",
    "hist48", "hist40_judge", "quantiles_nearest", "tune_agreement", "reasons_top8", "confirm_by_reason", "undone_paths", "latest_per_clip", "nn_topk_mean", "dup_components", "prf_by_category", "throughput_windows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = dict(QUERIES)
    names = list(HEADLINE)
    try:
        from bandsieve.llm.queries import queries as corpus

        queries |= corpus()
        names += [n for n in queries if n.startswith("op")]
    except ImportError:
        pass
    spark.range(1000).selectExpr("sum(id)").collect()  # the session is up
    began = time.perf_counter()
    corpora.results_u(spark, sf_dir)
    corpora.videos_u(spark, sf_dir)
    seconds = {"build_store": round(time.perf_counter() - began, 3)}
    for name in names:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
