"""The ad queries over a bounded table of clicks; ``shoptrail.streaming.jobs`` has the live ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.operators import ads


def blacklist(clicks: DataFrame, threshold: int = 100, initial: DataFrame | None = None) -> DataFrame:
    """Users to block: enough clicks on one ad in one day, or blocked before."""
    return ads.banned_users(clicks, threshold, initial)


def ad_city_counts(clicks: DataFrame, banned: DataFrame | None = None) -> DataFrame:
    """Clicks per day, area, city and ad; blocked users count unless ``banned`` is given."""
    if banned is None:
        return ads.count_by(clicks, ads.CITY_KEYS)
    counts = ads.drop_banned(ads.count_by(clicks, [*ads.CITY_KEYS, "user_id"]), banned)
    return ads.sum_by(counts, ads.CITY_KEYS)


def ad_area_top(clicks: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most clicked ads of each day and area, as JSON text."""
    return ads.ads_json(ads.top_ads(ads.count_by(clicks, ads.AREA_KEYS), k))


def ad_trend(clicks: DataFrame, as_of: str | Column, width: int = 60, bucket: int = 10) -> DataFrame:
    """Clicks of the last ``width`` seconds before ``as_of``, per bucket, in order of time."""
    moment = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return ads.ad_trend(clicks, moment, width, bucket)
