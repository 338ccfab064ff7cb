"""Physical-plan checks: the properties the design relies on at scale."""

from centrix.operators.assign import all_pairs, assign, co_partitioned, distinct_points, nearest_all_ties, pair_distances_joined
from centrix.operators.update import cluster_sums
from centrix.sources import testdata as td
from centrix.sources.text import load_points
from tests.conftest import SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_assignment_is_map_only(spark):
    p, s = td.points2(spark, SF), td.start2(spark, SF)
    for df in (assign(p, s, method="sql"), assign(p, s, method="arrow"), nearest_all_ties(p, s), all_pairs(p, s)):
        plan = _plan(df)
        assert "Exchange" not in plan and "Join" not in plan, plan


def test_aggregates_combine_map_side(spark):
    p, s = td.points2(spark, SF), td.start2(spark, SF)
    for df in (distinct_points(p), cluster_sums(assign(p, s, keep_coord=True), 2)):
        plan = _plan(df)
        assert ("partial_count" in plan or "partial_sum" in plan) and "Exchange hashpartitioning" in plan, plan


def test_co_partitioned_tables_join_without_a_shuffle_of_points(spark):
    p, s = co_partitioned(td.points64(spark, SF)), td.start64(spark, SF)
    df = pair_distances_joined(all_pairs(p, s), p, s)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    main = plan.split("Subquery")[0]
    assert "SortMergeJoin" in main and "Exchange hashpartitioning(point_id" not in main, plan


def test_numbered_lines_scan_the_text_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 2\n3 4\n")
    plan = _plan(load_points(spark, str(tmp_path / "a.txt")))
    assert "FileScan text" not in plan and "SinglePartition" not in plan.split("Window")[0], plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(td.points2(spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan, plan


def test_sql_function_with_scalar_subquery_is_map_only(spark):
    from centrix.functions.vector import register_sql_functions
    register_sql_functions(spark)
    td.points2(spark, SF).createOrReplaceTempView("plan_points2")
    td.start2(spark, SF).createOrReplaceTempView("plan_start2")
    df = spark.sql("SELECT point_id, nearest_centroid(CAST(coord AS ARRAY<DOUBLE>), "
                   "(SELECT array_sort(collect_list(struct(cluster_id, coord))) FROM plan_start2)) AS b "
                   "FROM plan_points2")
    plan = _plan(df)
    main = plan.split("Subquery")[0]
    assert "Join" not in plan and "Exchange hashpartitioning(point_id" not in main, plan
    assert "Subquery" in plan or "subquery" in plan
