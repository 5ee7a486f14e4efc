"""Ad-click counts, rankings, bans and trends over a table of parsed clicks."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.times import SECOND_DASHED, bucket_start, time_to_text
from shoptrail.operators.filters import at_least
from shoptrail.operators.ranking import top_per_group

USER_KEYS = ["date", "ad_id", "user_id"]
CITY_KEYS = ["date", "area", "city", "ad_id"]
AREA_KEYS = ["date", "area", "ad_id"]


def count_by(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Clicks per key; each task sends one row per key it has seen, however hot the key."""
    return clicks.groupBy(*keys).agg(F.count("*").alias("n"))


def sum_by(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Roll counts up to fewer keys, or merge counts of equal keys."""
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"))


def top_ads(area_counts: DataFrame, k: int = 3) -> DataFrame:
    """The most clicked ads of each day and area; equal counts by ad id."""
    return top_per_group(area_counts, ["date", "area"], [F.desc("n"), F.asc("ad_id")], k)


def ads_json(ranked: DataFrame) -> DataFrame:
    """The ranked ads of each day and area as one JSON text ``{ad: clicks}``, best first."""
    entries = F.array_sort(F.collect_list(F.struct("rank", F.col("ad_id").cast("string").alias("ad"), "n")))
    pairs = F.transform(entries, lambda e: F.struct(e["ad"].alias("key"), e["n"].alias("value")))
    return ranked.groupBy("date", "area").agg(F.to_json(F.map_from_entries(pairs)).alias("top_ads"))


def from_json_ads(top: DataFrame) -> DataFrame:
    """The rows ``date, area, ad_id, n`` of ranked ads in JSON form."""
    counts = F.from_json("top_ads", "map<string,bigint>")
    return top.select("date", "area", F.explode(counts).alias("ad_id", "n"))


def drop_banned(clicks: DataFrame, banned: DataFrame) -> DataFrame:
    """Rows of users that are not banned, repeats kept.

    Works on clicks as on counts. Counts are few per user, so counting first keeps a hot user out
    of this join. Spark broadcasts the bans if it knows them to be small, as it does of a table
    (``sinks.tables.written``); otherwise both sides are shuffled and adaptive execution splits a
    hot user's rows.
    """
    return clicks.join(banned.select("user_id"), "user_id", "left_anti").select(*clicks.columns)


def banned_users(clicks: DataFrame, threshold: int = 100, initial: DataFrame | None = None) -> DataFrame:
    """Users with ``threshold`` clicks or more on one ad in one day, and those banned before."""
    counts = count_by(clicks, USER_KEYS)
    if initial is None:
        return at_least(counts, threshold).select("user_id").distinct()
    found = at_least(drop_banned(counts, initial), threshold).select("user_id")
    return found.union(initial.select("user_id")).distinct()


def ban_times(clicks: DataFrame, heavy: DataFrame, threshold: int = 100, tie: str = "event_id") -> DataFrame:
    """The click ``(user_id, ban: (ts, tie))`` that gets a user banned, in order of ``ts`` and ``tie``.

    ``heavy`` lists the days, ads and users that reach the threshold (``at_least`` of ``count_by``);
    only their clicks are put in order, and only the first ``threshold`` of each leave a map task.
    """
    own = clicks.select(*USER_KEYS, "ts", tie).join(heavy.select(*USER_KEYS), USER_KEYS, "left_semi")
    first = top_per_group(own, USER_KEYS, [F.asc("ts"), F.asc(tie)], threshold)
    crossing = first.filter(F.col("rank") == threshold)
    return crossing.groupBy("user_id").agg(F.min(F.struct("ts", tie)).alias("ban"))


def clicks_until_ban(clicks: DataFrame, bans: DataFrame, tie: str = "event_id") -> DataFrame:
    """Clicks up to and with the one that gets their user banned.

    This is what a filter that knew every ban at once would let through. ``bans`` come from
    ``ban_times``; they are joined like those of ``drop_banned``.
    """
    kept = F.col("ban").isNull() | (F.struct("ts", tie) <= F.col("ban"))
    return clicks.join(bans, "user_id", "left").filter(kept).select(*clicks.columns)


def bucket_label(start: Column) -> Column:
    """Text form of a bucket's start."""
    return time_to_text(start, SECOND_DASHED)


def ad_trend(
    clicks: DataFrame, as_of: Column, width: int = 60, bucket: int = 10, arrival: str = "arrival"
) -> DataFrame:
    """Clicks that arrived in the ``width`` seconds before ``as_of``, per click-time bucket, in order."""
    since = as_of - F.make_dt_interval(secs=F.lit(width))
    recent = clicks.filter((F.col(arrival) >= since) & (F.col(arrival) < as_of))
    counts = recent.groupBy(bucket_start(F.col("ts"), bucket).alias("start")).agg(F.count("*").alias("n"))
    return counts.orderBy("start").select(bucket_label(F.col("start")).alias("bucket"), "n")


def trend_panes(
    clicks: DataFrame, width: int = 60, slide: int = 10, bucket: int = 10, arrival: str = "arrival"
) -> DataFrame:
    """Clicks per pane of arrival and bucket of click time.

    Panes are the longest intervals that every window is made of, so one count of a click serves all
    windows that overlap it. Works on a stream as well, where a watermark on arrival lets panes go.
    """
    pane = F.window(arrival, f"{math.gcd(width, slide)} seconds").alias("pane")
    counts = clicks.groupBy(pane, bucket_start(F.col("ts"), bucket).alias("bucket_start")).agg(F.count("*").alias("n"))
    return counts.select(F.col("pane.start").alias("pane"), "bucket_start", "n")


def trend_windows(panes: DataFrame, width: int = 60, slide: int = 10) -> DataFrame:
    """Clicks per window of ``width`` seconds, one starting each ``slide`` seconds, and bucket."""
    pane = F.unix_seconds("pane")
    last = F.floor(pane / slide) * slide
    first = F.ceil((pane + (math.gcd(width, slide) - width)) / slide) * slide
    starts = F.when(first <= last, F.sequence(last, F.least(first, last), F.lit(-slide).cast("bigint")))
    copies = panes.select(F.explode(starts).alias("start"), "bucket_start", "n")
    counts = sum_by(copies, ["start", "bucket_start"])
    return counts.select(F.timestamp_seconds("start").alias("window_start"), "bucket_start", "n")


def ad_trend_sliding(
    clicks: DataFrame, width: int = 60, slide: int = 10, bucket: int = 10, arrival: str = "arrival"
) -> DataFrame:
    """The trend of every window of ``width`` seconds that starts each ``slide`` seconds."""
    windows = trend_windows(trend_panes(clicks, width, slide, bucket, arrival), width, slide)
    return windows.select("window_start", bucket_label(F.col("bucket_start")).alias("bucket"), "n")


def window_report(panes: DataFrame, start: Column, width: int = 60, slide: int = 10) -> DataFrame:
    """The trend of the window that begins at ``start``, in order of time; only its own panes are counted."""
    end = start + F.make_dt_interval(secs=F.lit(width))
    own = panes.filter((F.col("pane") >= start) & (F.col("pane") < end))
    one = trend_windows(own, width, slide).filter(F.col("window_start") == start).orderBy("bucket_start")
    return one.select(bucket_label(F.col("bucket_start")).alias("bucket"), "n")
