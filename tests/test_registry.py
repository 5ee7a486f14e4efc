"""Every registered query against its SQL oracle, and the plans of the heavy ones."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from oracle import oracle_rows, same, spark_rows

SF_DIR = "/root/testdata/sf0.001"


# The queries of the training-data operators have their own tests.
NAMES = [query.__name__ for query in registry._QUERIES]


def test_every_query_has_an_oracle():
    assert set(NAMES) <= registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    got = spark_rows(registry.queries()[name](spark, SF_DIR))
    want = oracle_rows(SF_DIR, registry.oracle_sql()[name])
    assert got[1], "no rows"
    assert same(got, want), (got[0], want[0], got[1][:3], want[1][:3])


def plan_of(spark, name):
    return registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    assert registry.entry(spark).count() == 10


@pytest.mark.parametrize("name", ["category_session_top10", "ad_area_top3"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    steps = re.findall(r"(?:WindowGroupLimit .*, (Final|Partial)\n)|(Exchange) hashpartitioning", plan)
    steps = [limit or exchange for limit, exchange in steps]
    at = steps.index("Final")
    assert steps[at : at + 3] == ["Final", "Exchange", "Partial"]


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("stream_", "table_", "counter_"))])
def test_no_python_in_the_plan(spark, name):
    plan = plan_of(spark, name)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_counts_shuffle_partial_sums_only(spark):
    plan = plan_of(spark, "category_counts")
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "ReadSchema: struct<event_type:string,props:string>" in plan


@pytest.mark.parametrize("name", ["blacklist_filtered_clicks", "clicks_until_ban"])
def test_clicks_are_not_shuffled_for_few_bans(spark, name):
    plan = plan_of(spark, name)
    assert "BroadcastHashJoin [user_id" in plan and "Exchange hashpartitioning" not in plan


def test_ban_times_cut_groups_before_the_shuffle(spark):
    clicks = registry._clicks(spark, SF_DIR)
    heavy = registry.written(registry.heavy_user_ad_days(spark, SF_DIR))
    plan = registry.ads.ban_times(clicks, heavy)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"row_number\(\), 100, Final.*Exchange.*row_number\(\), 100, Partial", plan, re.DOTALL)
    # The listed groups are few, so clicks meet them without a shuffle of their own.
    assert re.search(r"Partial.*BroadcastHashJoin \[date", plan, re.DOTALL)


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith(("ad_", "blacklist", "user_ad", "heavy"))])
def test_clicks_are_never_on_the_build_side(spark, name):
    """The cities are broadcast; what is read of the events stays where it is."""
    plan = plan_of(spark, name)
    cities = re.findall(r"BroadcastHashJoin \[city_key.*?, (BuildLeft|BuildRight)", plan)
    assert cities and set(cities) == {"BuildRight"}


@pytest.mark.parametrize("name", ["page_flow_ratio_bucketed", "page_avg_dwell_bucketed"])
def test_stored_sessions_are_followed_without_exchange_or_sort(spark, name):
    registry.apply_settings(spark)
    below = plan_of(spark, name).split("Window [lead(", 1)[1]
    assert "Bucketed: true" in below and "Exchange" not in below and "Sort" not in below


def test_a_long_list_filters_the_actions_before_the_shuffle(spark, tmp_path):
    name = "product_clicks_semi"
    want = spark_rows(registry.queries()[name](spark, SF_DIR))
    path = str(tmp_path / "visits")
    registry._actions(spark, SF_DIR).write.parquet(path)
    part = spark.read.parquet(f"{SF_DIR}/part.parquet").filter(F.col("p_size") >= registry.PART_SIZE)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        clicks = registry.categories.clicks_on_products(spark.read.parquet(path), part, "p_partkey").select("event_id", "click_product_id")
        plan = clicks._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan.split("SortMergeJoin")[1].split("Exchange")[1]
        assert spark_rows(clicks) == want
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_sql_entry_plans(spark):
    """Bounds and names are parameters; no join comes of the functions."""
    plan = plan_of(spark, "category_events_sql")
    assert "Generate explode" in plan and "Join" not in plan


def test_too_many_cities_are_refused(spark, monkeypatch):
    monkeypatch.setattr(registry.event_views, "MOST_CITIES", 24)
    with pytest.raises(ValueError, match="cities"):
        registry.ad_city_counts(spark, SF_DIR)


def test_page_ids_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "visits")
    registry._actions(spark, SF_DIR).write.parquet(path)
    plan = registry.flows.page_views(spark.read.parquet(path), "1,2,03")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^]]*In\(page_id, \[1,2\]\)", plan) or "In(page_id, [1,2])" in plan


def test_one_window_counts_its_own_clicks_only(spark):
    plan = plan_of(spark, "ad_trend_window")
    above, below = plan.split("HashAggregate", 1)[0], plan[plan.index("Generate") :]
    assert "Generate" in plan and re.search(r"Filter .*make_dt_interval|Filter .*arrival|Filter .*2024-01-15", below) and above
