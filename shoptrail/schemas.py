"""Fixed schemas of the input tables, the click log and the result tables."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("gender", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

CITY_INFO = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# Keyed tables that the streaming jobs maintain.
USER_AD_COUNTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("ad_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)

CITY_AD_COUNTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("ad_id", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)

AREA_AD_COUNTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("ad_id", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)

AREA_TOP_ADS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("top_ads", T.StringType()),
    ]
)

BANNED_USERS = T.StructType([T.StructField("user_id", T.StringType())])

# Until when, in epoch seconds, windows of the trend have been reported.
TREND_CLOCK = T.StructType([T.StructField("clock", T.IntegerType()), T.StructField("until", T.LongType())])

TREND_COUNTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("pane", T.TimestampType()),
        T.StructField("bucket_start", T.TimestampType()),
        T.StructField("n", T.LongType()),
    ]
)

WINDOW_COUNTS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("bucket_start", T.TimestampType()),
        T.StructField("n", T.LongType()),
    ]
)
