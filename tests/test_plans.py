"""What must hold in the physical plans, whatever the size of the data."""

import pytest
from plans import plan_of

from shoplens.plans import all_queries

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return plan_of(all_queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["recommend_all", "knn_recommend", "price_drop_targets", "can_send", "compare_runs",
                                  "anomaly_scan", "preference_with_fallback", "alerts", "category_best"])
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["recent_viewed", "can_send", "category_best"])
def test_rank_limit_comes_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


def test_time_window_and_columns_reach_the_scan(spark):
    text = plan(spark, "active_users")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    counts = plan(spark, "popular_products")
    assert "value" not in counts.split("ReadSchema: struct<")[1].split(">")[0]


def test_taste_shuffles_no_vectors(spark):
    text = plan(spark, "preference_fold")
    exchange = text[text.index("Exchange hashpartitioning"):].splitlines()[1]
    assert "product_vector" not in exchange and text.count("Exchange hashpartitioning") == 1
