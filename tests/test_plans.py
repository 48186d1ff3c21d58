"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import all_queries, etl, markdown
from millrace.session import table

QUERIES = all_queries()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_count_combines_before_the_shuffle(spark, sf_dir):
    plan = physical(QUERIES["a4_word_count"](spark, sf_dir))
    assert "partial_count" in plan and plan.count("HashAggregate") >= 2


def test_combined_counts(spark, sf_dir):
    plan = physical(QUERIES["a8_combined_counts"](spark, sf_dir))
    upper, lower = plan.split("Exchange", 1)
    assert "HashAggregate" in upper and "partial_count" in lower


def test_partitions_are_pruned(spark, sf_dir):
    plan = physical(etl.partitioned_orders(spark, sf_dir).where("year = 1998"))
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "year" in line.split("PartitionFilters")[1].split("]")[0]


def test_small_dimensions_are_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" in physical(QUERIES["j2_join_star"](spark, sf_dir))


def test_no_broadcast_beyond_the_threshold(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("j2_join_star", "j1_broken_links", "j4_semi_filter", "a12_regular_report", "w1_rank_within", "g3_remaining_lines", "m9_tfidf"):
            assert "BroadcastHashJoin" not in physical(QUERIES[name](spark, sf_dir)), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in physical(QUERIES["o2_top_k"](spark, sf_dir))


def test_cleaning_needs_no_shuffle(spark, sf_dir):
    from millrace.operators import shell

    docs = table(spark, sf_dir, "documents").selectExpr("source AS path", "text AS value")
    assert "Exchange" not in physical(shell.clean_shell_blocks(docs, markdown.RENAMES))
    assert "Exchange" not in physical(shell.mark_fences(docs))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = physical(QUERIES["p13_filter_rows"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "l_tax" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "pjaow" or n in ("g1_pseudonymize", "g4_consent_filter", "g8_redact_text", "m9_tfidf", "m20_drift_report")))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    if name.startswith("a10"):
        return  # reads what it wrote, see the quantile tests
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_windows_are_partitioned(spark, sf_dir):
    for name in ("w1_rank_within", "w2_lag_delta", "w3_running_total", "w3_moving_mean", "m18_rolling_anomalies"):
        assert "Exchange SinglePartition" not in physical(QUERIES[name](spark, sf_dir)), name


@pytest.mark.parametrize("name", ["w1_rank_within", "w2_lag_delta", "w3_running_total"])
def test_windows_and_the_join_of_parts_share_an_exchange(spark, sf_dir, name):
    """Without broadcasts, rows with their window columns are joined where they lie: no exchange stands between window and join."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join, left = plan.split("Join", 1)[1].split("\n", 1)
    window = left.split("Window", 1)[0]
    assert "_group" in join and "Exchange" not in window, window


def test_the_audit_matches_each_text_once(spark, sf_dir):
    plan = physical(QUERIES["a1_link_audit_summary"](spark, sf_dir))
    assert plan.count("ReadSchema: struct<") == 2 and sum("text:string" in x for x in plan.splitlines() if "ReadSchema" in x) == 1


def test_lines_are_summed_once_for_all_models(spark, sf_dir):
    from millrace.plans import learning

    train, test, _ = learning._large(spark, sf_dir)
    assert "l_discount" not in physical(train) and "l_discount" not in physical(test)


def test_counts_of_terms_stay_where_they_are_cut(spark):
    from millrace.ml import relations

    docs = spark.createDataFrame([(i, f"a b{'c' * (i % 7)} a") for i in range(50)], "doc_id long, text string")
    weighted = relations.tfidf(docs, "doc_id", "text")
    assert "hashpartitioning(term" not in physical(weighted)
    assert weighted.count() == 100 and weighted.agg(F.sum("tf")).first()[0] == 150
