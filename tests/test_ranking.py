import re

import pytest
from conftest import plan_of
from pyspark.sql import Window, functions as F

from stationflow.operators import gap, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score and one group; some groups are NULL."""
    hot = F.col("id") % 3 == 0
    return spark.range(20000).select(
        "id",
        F.when(hot, 7.0).otherwise((F.hash("id") % 1000).cast("double")).alias("score"),
        F.when(hot, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 11).cast("string"))
        .alias("kind"),
    )


def order():
    return [F.col("score").desc(), "id"]


def mismatches(df, name, window):
    expected = F.row_number().over(window)
    return df.withColumn("_want", expected).filter(F.col(name) != F.col("_want")).count()


def test_global_row_number(spark, skewed):
    numbered = ranking.global_row_number(skewed, order(), "n")
    assert numbered.count() == 20000
    assert mismatches(numbered, "n", Window.orderBy(*order())) == 0


@pytest.mark.parametrize("by", ["kind", ["kind", "score"]])
def test_rank_in_groups_of_any_size(spark, skewed, by):
    ranked = ranking.rank_in(skewed, by, order(), "n")
    assert ranked.count() == 20000
    assert mismatches(ranked, "n", Window.partitionBy(by).orderBy(*order())) == 0


def test_a_hot_group_fills_several_buckets(spark, skewed):
    with_small_buckets = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in with_small_buckets.items():
        spark.conf.set(name, value)
    try:
        placed = ranking.place_in_order(skewed, order())
    finally:
        for name in with_small_buckets:
            spark.conf.unset(name)
    buckets = placed.filter("kind = 'hot'").select(ranking.BUCKET).distinct().count()
    largest = placed.groupBy(ranking.BUCKET).count().agg(F.max("count")).first()[0]
    assert buckets > 1
    assert largest < 20000 / 4


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(1, 5.0, "a")], "id int, score double, kind string")
    assert ranking.global_row_number(few, order(), "n").first().n == 1
    assert ranking.rank_in(few.limit(0), "kind", order(), "n").count() == 0


def test_no_single_task_over_rows(spark, skewed):
    """Only the table of bucket sizes may meet in one task."""
    numbered = ranking.global_row_number(skewed, order(), "n")
    physical = plan_of(numbered).split("== Physical Plan ==")[1]
    assert physical.count("SinglePartition") == 1
    ranked = ranking.rank_in(skewed, "kind", order(), "n")
    assert "SinglePartition" not in plan_of(ranked).split("== Physical Plan ==")[1]


def test_ranks_in_few_groups_move_no_rows(spark, skewed):
    """Once placed, only counts per bucket and group are shuffled, not the rows."""
    placed = ranking.place_in_order(skewed, order(), "kind")
    ranked = ranking.number_rows_within(placed, placed, "kind", "n")
    assert "Exchange hashpartitioning" not in plan_of(ranked).split("== Physical Plan ==")[1]
    assert mismatches(ranked, "n", Window.partitionBy("kind").orderBy(*order())) == 0


def test_mart_is_placed_rows_and_counts(spark, sf):
    """The mart reads its placed rows once, without a join that shuffles them."""
    from catalogue import queries as q

    physical = plan_of(q.build_mart(spark, sf)).split("== Physical Plan ==")[1]
    assert "SortMergeJoin" not in physical and "Window [row_number" not in physical
    assert set(re.findall(r"hashpartitioning\((\w+)#", physical)) <= {ranking.BUCKET}


def test_mart_ranks(spark, sf):
    from catalogue import queries as q

    mart = q.stored_mart(spark, sf)
    n = mart.count()
    ranks = mart.agg(
        F.count_distinct("overall_gap_rank"), F.min("overall_gap_rank"), F.max("overall_gap_rank")
    ).first()
    assert tuple(ranks) == (n, 1, n)
    peaks = mart.groupBy("station_id").agg(F.count_if("is_peak_gap_hour").alias("n"))
    assert peaks.filter("n <> 1").count() == 0
    firsts = mart.groupBy("hour_of_day").agg(
        F.max("supply_gap_score").alias("top"),
        F.max(F.when(F.col("gap_rank_within_hour") == 1, F.col("supply_gap_score"))).alias("first"),
    )
    assert firsts.filter("top <> first").count() == 0
    assert mart.columns[-5:] == [
        "overall_gap_rank",
        "gap_rank_within_hour",
        "worst_hour_rank_for_station",
        "is_peak_gap_hour",
        "gap_severity",
    ]


def test_top_k_needs_no_full_sort(spark, sf):
    from catalogue import queries as q

    plan = plan_of(gap.worst_gaps(q.scored(spark, sf), 10))
    assert "TakeOrderedAndProject" in plan and "SinglePartition" not in plan
