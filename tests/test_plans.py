"""Plan checks: scale properties the registry claims (read from explain)."""

import pytest

from tessera.plans.registry import all_queries

Q = all_queries()


def plan(spark, sf, key):
    return Q[key].build(spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["win14_pareto_80", "smp05_kfold_by_position", "win17_fixed_size_teams",
                                 "seq28_fill_down_global"])
def test_global_orders_not_single_partition_window(spark, sf, key):
    """A window fed by a SinglePartition exchange may only run over the
    per-chunk summary (an aggregate keyed by the chunk), never over rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(spark, sf, key).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for i, line in enumerate(lines):
        if "Window [" not in line:
            continue
        below = [x for x in lines[i + 1:i + 6] if "Exchange" in x]
        if below and "SinglePartition" in below[0]:
            j = lines.index(below[0], i)
            child = lines[j + 1]
            assert "Aggregate" in child and ("_chunk" in child or "_qc" in child or "_q" in child), \
                f"{key}: single-partition window over non-summary input: {child.strip()[:120]}"


@pytest.mark.parametrize("key", ["join13_time_proximity", "join12_interval_overlap_pairs", "seq06_sessionize_30min",
                                 "join14_as_of_state", "join25_two_sum_pair_counts"])
def test_no_cartesian_product(spark, sf, key):
    p = plan(spark, sf, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("key", ["seq06_sessionize_30min", "agg01_pricing_summary", "join01_three_way_inner",
                                 "win05_running_total_chunked"])
def test_no_python_in_sql_native_operators(spark, sf, key):
    p = plan(spark, sf, key)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_filter_and_projection_pushdown(spark, sf):
    p = plan(spark, sf, "src07_parquet_pushdown")
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_partition_pruning(spark, sf):
    p = plan(spark, sf, "src09_partitioned_folders_pruned")
    assert "PartitionFilters" in p and "year" in p


def test_top_n_uses_window_group_limit(spark, sf):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(spark, sf, "flagship_top_parts_by_nation")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p
