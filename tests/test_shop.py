import pytest
from pyspark.sql import functions as F

from shop_rows import actions, at, values, visit
from shoptrail.operators import categories, flows, ranking, sessions
from shoptrail.operators.filters import at_least, between_dates
from shoptrail.plans import shop


def events(spark, **row):
    return values(categories.category_events(actions(spark, row)).select("category_id", "kind"))


def test_one_action_counts_by_its_first_kind(spark):
    assert events(spark, click_category_id=5, order_category_ids="6", pay_category_ids="7") == [("5", "click")]
    assert events(spark, order_category_ids="6", pay_category_ids="7") == [("6", "order")]
    assert events(spark, pay_category_ids="7") == [("7", "pay")]
    assert events(spark) == []


def test_lists_of_categories(spark):
    assert events(spark, order_category_ids="1,2,,") == [("1", "order"), ("2", "order")]
    assert events(spark, order_category_ids="1,1,1") == [("1", "order")] * 3
    assert events(spark, order_category_ids="1,,2") == [("", "order"), ("1", "order"), ("2", "order")]
    # Only commas: not blank, so the pay list is not looked at, yet no category.
    assert events(spark, order_category_ids=",", pay_category_ids="3") == []
    # Blank after stripping control characters: the pay list counts.
    assert events(spark, order_category_ids=" \t", pay_category_ids="3") == [("3", "pay")]


def test_ids_with_a_dash_stay_whole(spark):
    counts = categories.category_counts(
        categories.category_events(actions(spark, {"click_category_id": -5}, {"order_category_ids": "a-b"}))
    )
    assert values(counts) == [("-5", 1, 0, 0), ("a-b", 0, 1, 0)]


def test_hottest_ties_go_to_orders_then_pays_then_id(spark):
    counts = spark.createDataFrame(
        [("d", 5, 1, 0), ("c", 5, 2, 1), ("b", 5, 2, 3), ("a", 5, 2, 1), ("e", 9, 0, 0)],
        "category_id string, click_count long, order_count long, pay_count long",
    )
    assert [row.category_id for row in categories.hottest(counts, 4).collect()] == ["e", "b", "a", "c"]


def test_top10_with_dates_and_task(spark):
    rows = [{"click_category_id": c, "date": f"2019-07-{c:02d}"} for c in range(1, 15)]
    top = shop.category_top10(actions(spark, *rows), "2019-07-03", "2019-07-13", task_id="run")
    assert top.columns == ["taskId", "category_id", "click_count", "order_count", "pay_count"]
    assert values(top) == [("run", c, 1, 0, 0) for c in sorted(map(str, range(3, 14)))[:10]]


def test_date_bounds(spark):
    table = actions(spark, *[{"date": f"2019-07-{d:02d}"} for d in (1, 2, 3)])
    days = lambda *bounds: [v[0] for v in values(between_dates(table, *bounds).select("date"))]
    assert days("2019-07-02", "2019-07-03") == ["2019-07-02", "2019-07-03"]
    assert days(None, "2019-07-01") == ["2019-07-01"]
    assert len(days("", " \t\n")) == len(days()) == 3


def test_top_sessions(spark):
    clicks = [("a_b", 3), ("a_c", 3), ("x", 1)]
    rows = [{"click_category_id": 1, "session_id": s} for s, n in clicks for _ in range(n)]
    rows += [{"click_category_id": 2, "session_id": "x"}, {"order_category_ids": "1", "session_id": "o"}]
    result = shop.category_session_top10(actions(spark, *rows), k=1, n=2, task_id="run")
    assert result.columns == ["taskId", "categoryId", "sessionId", "clickCount"]
    assert values(result) == [("run", "1", "a_b", 3), ("run", "1", "a_c", 3)]


def test_top_per_group_beyond_the_group_limit(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 5 < 3, "hot").otherwise("other").alias("g"), "id")
    got = ranking.top_per_group(rows, ["g"], [F.desc("id")], 1200)
    assert got.count() == 2400
    assert got.agg(F.min("rank"), F.max("rank")).first() == (1, 1200)
    hot = [r.id for r in got.filter("g = 'hot'").orderBy("rank").collect()]
    assert hot == [i for i in range(4999, -1, -1) if i % 5 < 3][:1200]


def test_path(spark):
    assert flows.path_pages("1,2,3,,") == ["1", "2", "3"]
    assert flows.path_pairs("1,2,1,2") == [("1", "2"), ("2", "1")]
    assert flows.path_pairs("5") == []


def test_page_flow(spark):
    table = actions(
        spark,
        *visit("a", 1, 2, 3),  # 1-2, 2-3
        *visit("b", 1, 9, 2),  # a detour is no step
        *visit("c", 1),  # a view without a step
        *visit("d", 2, 1, 2, 4),  # 1-2; the view of 2 before counts, 2-1 is off the path
    )
    ratios = shop.page_flow_ratio(table, "1,2,3,4")
    assert values(ratios) == [(1, 2, 0.5), (2, 3, 0.25)]
    pairs = sessions.page_pairs(sessions.with_next_action(table, ["page_id"]))
    steps = flows.with_page_views(flows.pair_counts(pairs, "1,2,3,4"), flows.page_views(table, "1,2,3,4"))
    assert values(flows.conversion_ratio(steps)) == values(ratios)


def test_pages_compare_as_text(spark):
    assert values(shop.page_flow_ratio(actions(spark, *visit("a", 1, 2)), "01,2")) == []
    assert values(shop.page_flow_ratio(actions(spark, *visit("a", 1, 2)), "1")) == []


def test_views_default_to_one(spark):
    steps = spark.createDataFrame([(1, 2, 3)], "from_page long, to_page long, n long")
    views = spark.createDataFrame([], "page_id long, views long")
    assert values(flows.with_page_views(steps, views)) == [(1, 2, 3, 1)]


def test_adjacency_is_found_after_the_date_filter(spark):
    rows = visit("a", 1, 9, 2)
    rows[1]["date"] = "2019-07-02"
    assert values(shop.page_flow_ratio(actions(spark, *rows), "1,2", "2019-07-01", "2019-07-01")) == [(1, 2, 1.0)]


def test_equal_times_follow_the_event_id(spark):
    rows = [{"page_id": p, "event_id": i, "action_time": at(0)} for i, p in [(3, 30), (1, 10), (2, 20)]]
    pairs = sessions.page_pairs(sessions.with_next_action(actions(spark, *rows), ["page_id"]))
    assert values(pairs) == [(10, 20), (20, 30)]


def test_dwell(spark):
    rows = [*visit("a", 5, 6, step=1), *visit("b", 5, 6, step=1), *visit("c", 5, 6, step=2), *visit("d", 5)]
    assert values(shop.page_avg_dwell_ms(actions(spark, *rows))) == [(5, 1333)]


def test_at_least(spark):
    assert at_least(spark.createDataFrame([(99,), (100,)], "n long"), 100).count() == 1


@pytest.mark.parametrize("hot_rows, slots", [(1, sessions.SLOTS), (4, 16), (40, sessions.SLOTS), (1, 4)])
def test_hot_sessions_are_followed_like_others(spark, hot_rows, slots):
    n = 600
    table = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") % 7 == 0, F.lit(""))
        .when(F.col("id") % 5 == 0, F.lit("bot"))
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 97).cast("string")))
        .alias("session_id"),
        (F.pmod(F.xxhash64("id"), F.lit(9))).alias("page_id"),
        # Several days, several rows in one second, ids that do not grow with time.
        F.date_format(
            F.timestamp_seconds(F.lit(1_562_000_000) + F.floor((F.col("id") * 37) % n / 4) * 1700),
            "yyyy-MM-dd HH:mm:ss",
        ).alias("action_time"),
        F.col("id").alias("event_id"),
    )
    plain = sessions.with_next_action(table, hot_rows=None)
    sliced = sessions.with_next_action(table, hot_rows=hot_rows, slots=slots)
    assert sliced.columns == plain.columns
    assert values(sliced) == values(plain)
    slots = [row.slot for row in sessions.hot_slots(table, hot_rows=40).collect()]
    slot = F.pmod(F.xxhash64("session_id"), F.lit(sessions.SLOTS))
    hot = {row.session_id for row in table.filter(slot.isin(slots)).select("session_id").collect()}
    assert hot >= {None, "", "bot"} and len(hot) < 10


def test_no_session_is_hot_where_all_are_alike(spark):
    table = spark.range(100_000).select((F.col("id") % 50_000).cast("string").alias("session_id"))
    assert sessions.hot_slots(table, hot_rows=1, slots=1024).count() < 1024 / 2
    assert sessions.hot_slots(table).count() == 0


@pytest.mark.parametrize("more, hot", [(0, False), (1, True)])
def test_a_session_is_hot_from_twice_the_mean_on(spark, more, hot):
    """With 8 slots and 80 rows twice the mean is 20 rows; a session just below stays whole."""
    rows = [("bot",)] * (19 + more) + [(f"s{i}",) for i in range(61 - more)]
    table = spark.createDataFrame(rows, "session_id string")
    slot = F.pmod(F.xxhash64("session_id"), F.lit(8))
    table = table.filter((F.col("session_id") == "bot") | (slot != F.pmod(F.xxhash64(F.lit("bot")), F.lit(8))))
    others = spark.range(80 - table.count()).select(F.lit(table.filter("session_id != 'bot'").first()[0]).alias("session_id"))
    found = sessions.hot_slots(table.union(others), hot_rows=1, slots=8)
    assert (found.filter(found.slot == F.pmod(F.xxhash64(F.lit("bot")), F.lit(8))).count() == 1) == hot
