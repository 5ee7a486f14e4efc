import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shop_rows import values
from shoptrail.functions.text import zero_last_character
from shoptrail.functions.times import epoch_ms_to_text
from shoptrail.operators import ads
from shoptrail.plans import ads as plans
from shoptrail.sources.clicks import line_values, parse_click_lines

NOON = 1_562_068_800_000  # 2019-07-02 12:00:00 UTC


def clicks(spark, *rows):
    """Clicks from ``(seconds after noon, area, city, user, ad)``; they arrive at once."""
    lines = [(f"{NOON + int(s * 1000)} {area} {city} {user} {ad}",) for s, area, city, user, ad in rows]
    parsed = parse_click_lines(spark.createDataFrame(lines, "value string"))
    return parsed.withColumn("arrival", F.col("ts")).withColumn("event_id", F.monotonically_increasing_id())


def by(user, ad="1", n=1, start=0):
    return [(start + i, "north", "x", user, ad) for i in range(n)]


def test_parse(spark):
    lines = spark.createDataFrame([(bytearray(f"{NOON + 999} north x 7 3".encode()), None)], "value binary, key binary")
    row = parse_click_lines(line_values(lines)).first()
    assert row.asDict() == {
        "ts": dt.datetime(2019, 7, 2, 12, 0, 0, 999000),
        "date": "2019-07-02",
        "area": "north",
        "city": "x",
        "user_id": "7",
        "ad_id": "3",
    }


@pytest.mark.parametrize("line", ["noon north x 7 3", f"{NOON} north x 7", ""])
def test_a_bad_line_fails_the_query(spark, line):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|INVALID_ARRAY_INDEX"):
        parse_click_lines(spark.createDataFrame([(line,)], "value string")).collect()


def test_blacklist(spark):
    table = clicks(spark, *by("u", n=3), *by("v", n=2), *by("v", "2", n=2), *by("v", n=1, start=86400), *by("old"))
    assert values(plans.blacklist(table, 3)) == [("u",)]
    initial = spark.createDataFrame([("old",), ("gone",)], "user_id string")
    assert values(plans.blacklist(table, 3, initial)) == [("gone",), ("old",), ("u",)]
    assert values(plans.blacklist(table)) == []
    kept = ads.drop_banned(table, plans.blacklist(table, 3))
    assert values(kept.groupBy("user_id").count()) == [("old", 1), ("v", 5)]


def test_clicks_until_ban(spark):
    table = clicks(spark, *by("u", "1", n=2), *by("u", "2", n=4, start=2), *by("u", "1", n=2, start=9), *by("v", n=2))
    heavy = ads.at_least(ads.count_by(table, ads.USER_KEYS), 3)
    kept = ads.clicks_until_ban(table, ads.ban_times(table, heavy, 3))
    assert kept.columns == table.columns
    assert values(kept.groupBy("user_id", "ad_id").count()) == [("u", "1", 2), ("u", "2", 3), ("v", "1", 2)]


def test_city_and_area_counts(spark):
    table = clicks(spark, *by("u", n=2), (0, "north", "y", "u", "1"), (0, "south", "x", "v", "1"))
    cities = plans.ad_city_counts(table)
    assert values(cities.drop("date")) == [("north", "x", "1", 2), ("north", "y", "1", 1), ("south", "x", "1", 1)]
    areas = ads.sum_by(cities, ads.AREA_KEYS)
    assert values(areas) == values(ads.count_by(table, ads.AREA_KEYS))
    banned = spark.createDataFrame([("u",)], "user_id string")
    assert values(plans.ad_city_counts(table, banned).drop("date")) == [("south", "x", "1", 1)]


def test_top_ads_as_json(spark):
    rows = [(i, "north", c, "u", ad) for ad, n in [("3", 5), ("10", 2), ("2", 2), ("9", 1), ("1", 7)] for i in range(n)
            for c in ["x"]]
    row = plans.ad_area_top(clicks(spark, *rows)).first()
    assert (row.date, row.area, row.top_ads) == ("2019-07-02", "north", '{"1":7,"3":5,"10":2}')
    assert list(json.loads(row.top_ads)) == ["1", "3", "10"]


def test_trend_takes_the_last_minute(spark):
    table = clicks(spark, *[(s, "n", "x", "u", "1") for s in (-61, -60, -55.001, -1, -0.001, 0, 5)])
    trend = plans.ad_trend(table, "2019-07-02 12:00:00")
    assert [tuple(r) for r in trend.collect()] == [
        ("2019-07-02 11-59-00", 2),
        ("2019-07-02 11-59-50", 2),
    ]


def test_window_report(spark):
    table = clicks(spark, *[(s, "n", "x", "u", "1") for s in (-1, 0, 5, 59, 60)])
    report = ads.window_report(ads.trend_panes(table), F.lit("2019-07-02 12:00:00").cast("timestamp"))
    assert [tuple(r) for r in report.collect()] == [("2019-07-02 12-00-00", 2), ("2019-07-02 12-00-50", 1)]


def test_bucket_label_is_the_text_with_its_last_digit_zeroed(spark):
    table = clicks(spark, *[(s / 7, "n", "x", "u", "1") for s in range(400)])
    zeroed = zero_last_character(epoch_ms_to_text(F.unix_millis("ts")))
    label = ads.bucket_label(ads.bucket_start(F.col("ts"), 10))
    assert table.filter(zeroed != label).count() == 0


@pytest.mark.parametrize("width, slide", [(60, 10), (30, 30), (60, 40), (10, 60), (25, 10)])
def test_sliding_panes_equal_windows(spark, width, slide):
    table = clicks(spark, *[(s * 1.7, "n", "x", "u", "1") for s in range(90)])
    table = table.withColumn("arrival", F.col("ts") + F.expr("interval 25 seconds"))
    if width > slide:
        window = F.window("arrival", f"{width} seconds", f"{slide} seconds")
    else:  # Spark has no windows with gaps between them: cut the gaps out of longer ones.
        window = F.window("arrival", f"{slide} seconds")
        into = F.unix_micros("arrival") - F.unix_micros(F.window("arrival", f"{slide} seconds").start)
        table = table.filter(into < width * 1_000_000)
    expected = table.groupBy(window, ads.bucket_start(F.col("ts"), 10).alias("b")).count()
    expected = expected.select("window.start", ads.bucket_label(F.col("b")), "count")
    assert values(ads.ad_trend_sliding(table, width, slide)) == values(expected)
