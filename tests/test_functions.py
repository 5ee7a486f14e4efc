import pytest
from pyspark.sql import functions as F

from shoptrail.functions import text, times


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "c string").select(column(F.col("c")).alias("x")).first().x


def test_split_list_drops_empty_parts_at_the_end_only(spark):
    expected = {
        "1,2,3": ["1", "2", "3"],
        "1,2,,": ["1", "2"],
        ",": [],
        ",,,": [],
        "1,,2": ["1", "", "2"],
        ",1": ["", "1"],
        "": [""],
        "7": ["7"],
        "1,2,\n": ["1", "2", "\n"],
    }
    for value, parts in expected.items():
        assert one(spark, text.split_list, value) == parts, value
    assert one(spark, text.split_list, None) is None


def test_split_list_takes_the_separator_as_plain_text(spark):
    assert one(spark, lambda c: text.split_list(c, "|"), "a|b||") == ["a", "b"]
    assert one(spark, lambda c: text.split_list(c, "-"), "3-click") == ["3", "click"]
    assert one(spark, lambda c: text.split_list(c, " "), "1 2  3 ") == ["1", "2", "", "3"]


def test_is_not_blank(spark):
    for value, expected in [(None, False), ("", False), (" \t\r\n\x01", False), (" a ", True), (" ", True)]:
        assert one(spark, text.is_not_blank, value) is expected, repr(value)


def test_times(spark):
    row = (
        spark.range(1)
        .select(
            times.epoch_ms_to_text(F.lit(1_562_000_125_999)).alias("dashed"),
            times.epoch_ms_to_text(F.lit(1_562_000_125_999), times.DAY).alias("day"),
            text.zero_last_character(times.epoch_ms_to_text(F.lit(1_562_000_125_999))).alias("bucket"),
            times.time_to_text(times.text_to_time(F.lit("2019-07-01 16:55:25"))).alias("round_trip"),
            times.text_to_epoch_ms(F.lit("2019-07-01 16:55:25")).alias("ms"),
            times.day_text(F.timestamp_millis(F.lit(1_562_000_125_999))).alias("day_text"),
            times.time_to_text(times.bucket_start(F.timestamp_millis(F.lit(1_562_000_125_999)), 10)).alias("start"),
        )
        .first()
    )
    assert row.dashed == "2019-07-01 16-55-25"
    assert row.day == row.day_text == "2019-07-01"
    assert row.bucket == "2019-07-01 16-55-20"
    assert row.round_trip == "2019-07-01 16:55:25"
    assert row.ms == 1_562_000_125_000
    assert row.start == "2019-07-01 16:55:20"


def test_text_times(spark):
    ms = lambda value: one(spark, times.text_to_epoch_ms, value)
    assert ms("2019-07-01 16:55:25") == ms("2019-7-1 16:55:25.9") == 1_562_000_125_000
    assert one(spark, lambda c: times.text_to_epoch_ms(c, times.SECOND_DASHED), "2019-07-01 16-55-25") == ms(
        "2019-07-01 16:55:25"
    )
    for bad in ("noon", "2019-13-01 00:00:00"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            ms(bad)


def test_json_text_field(spark):
    document = '{"startDate":"2019-07-01","n":3}'
    read = lambda key: one(spark, lambda c: text.json_text_field(c, key), document)
    assert (read("startDate"), read("n"), read("none")) == ("2019-07-01", "3", None)
