"""Benchmark the headline queries.

Runs each query on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]; one cold run, then the median of $BENCH_RUNS warm runs.
Queries execute fully through the ``noop`` sink (no rows are collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_top_parts_by_nation",   # scan + pre-agg + joins + top-n per group
    "agg01_pricing_summary",          # scan-aggregate
    "join01_three_way_inner",         # three-way join + aggregate
    "join13_time_proximity",          # bucketed time-near join
    "join14_as_of_state",             # union-sort as-of join
    "seq06_sessionize_30min",         # chunked lag + prefix sum sessionisation
    "win05_running_total_chunked",    # chunked running totals
    "win14_pareto_80",                # global prefix sum without a single-partition window
    "seq08_merge_intervals",          # interval merge
    "dwh06_scd2_history",             # SCD2
    "ver01_snapshot_diff",            # change capture
    "dwh11_star_query",               # star join
    "vec01_exact_topk_cosine",        # exact vector top-k
    "txt01_word_count",               # text explode + aggregate
    "txt05_recursive_chunks",         # Arrow mapInPandas chunker
    "smp05_kfold_by_position",        # global position by chunked prefix count
    "agg29_best_candidate_score",     # relational division by need signatures
    "vec06_cut_hits_best_per_doc",    # block product + one aggregate
    "join24_best_one_stop_route",     # suffix minimum + chunked as-of
    "evl04_experiment_summary",       # one baseline row per example
    "str11_stream_join_batch_form",   # stream-stream join on key and time bucket
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [a for a in sys.argv[1:]]
    from tessera.plans.registry import all_queries
    from tessera.session import get_session

    spark = get_session(app="tessera-bench")
    qs = all_queries()
    names = [n for n in HEADLINE if not only or any(o in n for o in only)]
    results, rows = {}, {}
    for name in names:
        q = qs[name]
        q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # cold run
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q.build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    li_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    t0 = time.perf_counter()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop") \
         .mode("overwrite").save()
    scan_s = time.perf_counter() - t0
    rows["lineitem_rows"] = li_rows
    rows["scan_agg_rows_per_s"] = round(li_rows / scan_s)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8")), "runs": runs, **rows}))


if __name__ == "__main__":
    main()
