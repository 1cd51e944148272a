"""Plan-shape guards for the scale design (checked on executed plans)."""

import pytest

import __spark_entry__ as E

D = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, D)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["genre_top10", "recent_ratings", "realtime_scores"])
def test_top_k_is_trimmed_before_the_shuffle(spark, name):
    p = plan(spark, name)
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["genre_top10", "item_similarity_dense", "content_similarity",
                                  "content_similarity_hashed", "candidate_items", "realtime_scores",
                                  "user_item_grid_count"])
def test_no_nested_loop_or_cartesian_join(spark, name):
    p = plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scans_are_pruned(spark):
    p = plan(spark, "avg_score")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in p
    assert "ReadSchema: struct<o_orderkey:bigint>" in p


def test_tag_sets_aggregate_partially(spark):
    assert "partial_collect_set" in plan(spark, "movie_search_docs")


def test_candidates_are_trimmed_before_the_shuffle(spark):
    from cinerank.operators import realtime
    from cinerank.sources import testdata as td
    ev = td.rating_events(spark, D)
    sim = spark.createDataFrame([(1, 1, 2, 0.9)], "mid int, rank int, rec_mid int, score double")
    p = realtime.candidate_items(realtime.latest_per_user(ev).select("uid", "mid"), sim, ev)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p
