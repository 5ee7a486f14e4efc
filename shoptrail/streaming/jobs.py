"""The live ad jobs on Structured Streaming.

Running counts live in the state store and are read from there; what leaves a job goes to tables of ``batch_tables``. Each takes a stream of parsed clicks, a folder for its tables and a checkpoint, and returns the
started query: ``query.awaitTermination()`` waits for it. A stopped job goes on from its checkpoint.
"""

import math
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoptrail import schemas
from shoptrail.operators import ads
from shoptrail.functions.times import bucket_start, day_text
from shoptrail.streaming.batch_tables import BatchTable, newest, summed, united

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
ALL_AVAILABLE = {"availableNow": True}


def user_ad_table(root: str) -> BatchTable:
    """Final clicks per day, ad and user of the days that left the state."""
    return BatchTable(f"{root}/user_ad_counts", schemas.USER_AD_COUNTS, summed(ads.USER_KEYS))


def banned_table(root: str) -> BatchTable:
    return BatchTable(f"{root}/banned", schemas.BANNED_USERS, united, day=None)


def city_counter_table(root: str) -> BatchTable:
    """Clicks per day, area, city and ad, added up over batches."""
    return BatchTable(f"{root}/city_counts", schemas.CITY_AD_COUNTS, summed(ads.CITY_KEYS))


def area_top_table(root: str) -> BatchTable:
    """Top ads of each day and area, newest ranking wins."""
    return BatchTable(f"{root}/area_top", schemas.AREA_TOP_ADS, newest(["date", "area"]))


def trend_table(root: str) -> BatchTable:
    """Clicks per pane of arrival and bucket, added up over batches; split by the day of arrival."""
    return BatchTable(f"{root}/trend", schemas.TREND_COUNTS, summed(["date", "pane", "bucket_start"]))


def trend_clock(root: str) -> BatchTable:
    """The end of the last window that was reported."""
    return BatchTable(f"{root}/trend_clock", schemas.TREND_CLOCK, newest(["clock"]), day=None)


def closed_window_table(root: str) -> BatchTable:
    """Windows of the trend that a watermark has closed."""
    return BatchTable(f"{root}/trend_closed", schemas.WINDOW_COUNTS, summed(["date", "window_start", "bucket_start"]))


def late_window_table(root: str) -> BatchTable:
    """Clicks that came when their window was closed, by window."""
    return BatchTable(f"{root}/trend_late", schemas.WINDOW_COUNTS, summed(["date", "window_start", "bucket_start"]))


def start(
    stream: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Run ``step(batch, batch_id)`` on every micro-batch."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(step).trigger(**trigger).start()


def to_console(
    stream: DataFrame, checkpoint: str, mode: str = "update", rows: int = 10,
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Print the first ``rows`` rows of every micro-batch."""
    writer = stream.writeStream.format("console").outputMode(mode).option("numRows", rows)
    return writer.option("truncate", False).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def running_counts(clicks: DataFrame, keys: list[str], expire_after: str | None = None) -> DataFrame:
    """Running clicks per key, kept in the state store.

    Counts are kept for ever unless ``expire_after`` is given: then a day leaves the state once
    clicks that much later have been seen, and clicks for a day that has left are dropped.
    ``keys`` hold ``date``.
    """
    if expire_after is None:
        return ads.count_by(clicks, keys)
    rest = [k for k in keys if k != "date"]
    day = F.window("ts", "1 day").alias("day")
    counts = clicks.withWatermark("ts", expire_after).groupBy(day, *rest).agg(F.count("*").alias("n"))
    return counts.select(day_text(F.col("day.start")).alias("date"), *rest, "n")


def finished_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch a job has finished, -1 for none. A reader beside the job goes by it, and so sees whole batches."""
    try:
        files = spark.read.text(f"{checkpoint}/commits").inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1
    return max((int(file.rsplit("/", 1)[1]) for file in files), default=-1)


def state_counts(spark: SparkSession, checkpoint: str, keys: list[str]) -> DataFrame:
    """The counts that ``running_counts`` of a job holds after its last finished batch, read from its state store."""
    state = spark.read.format("statestore").load(checkpoint)
    expiring = "window" in state.schema["key"].dataType.fieldNames()
    stored = {"date": day_text(F.col("key.window.start"))} if expiring else {}
    return state.select(*(stored.get(k, F.col(f"key.{k}")).alias(k) for k in keys), F.col("value.count").alias("n"))


def count_user_ads(
    clicks: DataFrame, root: str, checkpoint: str, expire_after: str | None = None,
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Keep running clicks per day, ad and user in the state store; ``user_ad_counts`` reads them.

    Nothing is written but the state, unless days expire: the final counts of a day that leaves the state go to a table.
    """
    counts = running_counts(clicks, ads.USER_KEYS, expire_after)
    if expire_after is None:
        writer = counts.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()
    return start(counts, user_ad_table(root).put, checkpoint, "append", trigger)


def user_ad_counts(spark: SparkSession, root: str, checkpoint: str, expire_after: str | None = None) -> DataFrame:
    """The counts of ``count_user_ads`` after its last finished batch, whatever the job is doing now."""
    counts = state_counts(spark, checkpoint, ads.USER_KEYS)
    if expire_after is None:
        return counts
    return counts.unionByName(user_ad_table(root).read(spark, finished_batch(spark, checkpoint)))


def count_city_ads(
    clicks: DataFrame, root: str, checkpoint: str, trigger: Mapping[str, object] = EVERY_5_SECONDS
) -> StreamingQuery:
    """Add each batch's clicks per day, area, city and ad to a table of counters."""
    table = city_counter_table(root)

    def step(batch: DataFrame, batch_id: int) -> None:
        table.put(ads.count_by(batch, ads.CITY_KEYS), batch_id)

    return start(clicks, step, checkpoint, trigger=trigger)


def block_heavy_clickers(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    threshold: int = 100,
    initial: DataFrame | None = None,
    admitted: Callable[[DataFrame, int], None] | None = None,
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Count clicks, and ban users who reach the threshold on one ad in one day.

    A ban holds for all ads and days from the next batch on; the batch that reaches the threshold
    still counts in full. Users are judged only by batches they click in. ``initial`` users are
    banned from the start; it must be the same on a restart. ``admitted`` gets, with each batch's number, the
    counts it changed of users that were not banned before.

    The state store holds the running count of every key, and a batch gets those it changed; no counter is written
    or read beside it (``state_counts`` shows them). They go on during a ban, so a user taken off the list by hand is
    judged with the clicks made meanwhile. New bans are put into a set.
    """
    banned = banned_table(root)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            known = spark.createDataFrame([], schemas.BANNED_USERS) if initial is None else initial.select("user_id")
        else:
            known = banned.read(spark, batch_id - 1)
        counts = ads.drop_banned(batch, known)
        # A batch is computed once, though two readers want it.
        counts = counts if admitted is None else counts.persist()
        found = ads.at_least(counts, threshold).select("user_id").distinct()
        banned.put(found.union(known) if batch_id == 0 else found, batch_id)
        if admitted is not None:
            admitted(counts, batch_id)
            counts.unpersist()

    return start(running_counts(clicks, ads.USER_KEYS), step, checkpoint, "update", trigger)


def rank_area_ads(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    k: int = 3,
    expire_after: str | None = None,
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Keep the top ``k`` ads of each day and area as JSON text.

    The state store holds the running counts of areas; a batch gets those it changed. As counts only grow, the new
    top ads are among the old ones and the changed ones, so no other count is read.
    """
    top = area_top_table(root)

    def step(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        days = [row["date"] for row in changed.select("date").distinct().collect()]
        before = ads.from_json_ads(top.read(batch.sparkSession, batch_id - 1, days)) if batch_id else changed.limit(0)
        touched = before.join(changed.select("date", "area").distinct(), ["date", "area"], "left_semi")
        known = touched.unionByName(changed).groupBy(*ads.AREA_KEYS).agg(F.max("n").alias("n"))
        top.put(ads.ads_json(ads.top_ads(known, k)), batch_id)
        changed.unpersist()

    return start(running_counts(clicks, ads.AREA_KEYS, expire_after), step, checkpoint, "update", trigger)


def keep_bad_lines(
    bad: DataFrame, folder: str, checkpoint: str, trigger: Mapping[str, object] = EVERY_5_SECONDS
) -> StreamingQuery:
    """Keep the lines that ``sources.clicks.sorted_out`` sets aside, each once, as Parquet in ``folder``.

    It runs beside the job that takes the good lines, with a checkpoint of its own.
    """
    writer = bad.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start(folder)


def live_ticks(spark: SparkSession, every: int = 1) -> DataFrame:
    """A stream of the time, ``arrival``, a row each ``every`` seconds, so that a chart moves on in silence."""
    seconds = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return seconds.filter(F.col("value") % every == 0).select(F.col("timestamp").alias("arrival"))


def chart_trend(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    width: int = 60,
    slide: int = 10,
    bucket: int = 10,
    arrival: str = "arrival",
    report: Callable[[DataFrame], None] | None = None,
    ticks: DataFrame | None = None,
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """Keep the click counts that the trend of every window is made of.

    Each batch adds its counts per pane to the table; nothing is dropped, however late a click is.
    ``ads.trend_windows`` over the table gives the windows. ``report`` gets, after a batch, all windows
    that ended since the last report, ``(window_start, bucket, n)`` in order of time. Clicks that arrive late count in the
    table, but no window is reported twice, and windows without clicks have no rows. A batch that runs again reports again.

    Without ``ticks`` only clicks tell the time: windows end with the newest pane of arrival that has one, and
    silence is not reported. With ``ticks``, a stream of times (``live_ticks``), windows end when a tick or click at or
    after their end has come; slides without clicks report too, without rows when their windows are empty.
    """
    table, clock = trend_table(root), trend_clock(root)
    pane_width = math.gcd(width, slide)
    stream = clicks.select(arrival, "ts")
    if ticks is not None:
        stream = stream.unionByName(ticks.select(F.col("arrival").alias(arrival), F.lit(None).cast("timestamp").alias("ts")))

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        panes = ads.trend_panes(batch, width, slide, bucket, arrival).persist()  # ticks have no bucket
        counts = panes.filter("bucket_start is not null")
        table.put(counts.withColumn("date", day_text(F.col("pane"))), batch_id)
        if report is not None:
            seconds = F.unix_seconds("pane")
            first, last = panes.agg(F.min(seconds), F.max(seconds)).first()
            before = clock.read(spark, batch_id - 1).first() if batch_id else None
            since = before["until"] if before else None
            seen = last if ticks is not None or last is None else last + pane_width
            since = first if since is None else since
            until = since if seen is None else max(seen, since)
            if until is not None and until > since:
                report(_ended(table, spark, batch_id, since, until, width, slide))
            clock.put(spark.createDataFrame([] if until is None else [(0, until)], schemas.TREND_CLOCK), batch_id)
        panes.unpersist()

    return start(stream, step, checkpoint, trigger=trigger)


def _ended(table: BatchTable, spark: SparkSession, batch_id: int, since: int, until: int, width: int, slide: int) -> DataFrame:
    """The windows that end after the epoch second ``since`` and by ``until``, in order of time."""
    low, high = (F.timestamp_seconds(F.lit(s)) for s in (since - width, until))
    days = spark.range(1).select(F.transform(F.sequence(low.cast("date"), high.cast("date")), lambda day: day.cast("string")))
    panes = table.read(spark, batch_id, days.first()[0])
    own = panes.filter((F.col("pane") >= low) & (F.col("pane") < high))
    end = F.unix_seconds("window_start") + width
    windows = ads.trend_windows(own, width, slide).filter((end > since) & (end <= until))
    return windows.orderBy("window_start", "bucket_start").select(
        "window_start", ads.bucket_label(F.col("bucket_start")).alias("bucket"), "n"
    )


def _late_before(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """The watermark that rows of a batch are judged by: the one of the batch before, from the offset log."""
    if batch_id == 0:
        return F.lit(0).cast("timestamp")
    log = spark.read.text(f"{checkpoint}/offsets/{batch_id - 1}")
    ms = log.select(F.get_json_object("value", "$.batchWatermarkMs").cast("bigint").alias("ms")).dropna().first()["ms"]
    return F.timestamp_millis(F.lit(ms))


def chart_closed_windows(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    delay: str,
    width: int = 60,
    slide: int = 10,
    bucket: int = 10,
    arrival: str = "arrival",
    trigger: Mapping[str, object] = EVERY_5_SECONDS,
) -> StreamingQuery:
    """The trend with bounded state: a window is written once, when a watermark ``delay`` behind the newest arrival closes it.

    Clicks for windows that are closed already are not lost: they are counted by window in a second table. Closed,
    late and open windows (``trend_so_far``) together are the trend of all clicks. ``slide`` is at most ``width``.
    """
    if slide > width:
        raise ValueError("windows with gaps between them have no native form; use chart_trend")
    closed, late = closed_window_table(root), late_window_table(root)
    window = F.window(arrival, f"{width} seconds", f"{slide} seconds").alias("w")
    start_of = bucket_start(F.col("ts"), bucket).alias("bucket_start")
    counted = clicks.withWatermark(arrival, delay).groupBy(window, start_of).agg(F.count("*").alias("n"))
    # The same batch once more as it came: what the watermark cuts off is found there.
    raw = clicks.select(F.lit(None).cast("timestamp").alias("window_start"), start_of, F.lit(1).cast("bigint").alias("n"), F.col(arrival).alias("at"))
    both = counted.select(F.col("w.start").alias("window_start"), "bucket_start", "n", F.lit(None).cast("timestamp").alias("at")).unionByName(raw)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        dated = lambda table: table.withColumn("date", day_text(F.col("window_start")))
        closed.put(dated(rows.filter("window_start is not null").drop("at")), batch_id)
        limit = _late_before(batch.sparkSession, checkpoint, batch_id)
        old = rows.filter(F.col("at") < limit).select(F.window("at", f"{width} seconds", f"{slide} seconds").alias("w"), "bucket_start")
        missed = old.filter(F.col("w.end") <= limit).groupBy(F.col("w.start").alias("window_start"), "bucket_start").agg(F.count("*").alias("n"))
        late.put(dated(missed), batch_id)
        rows.unpersist()

    return start(both, step, checkpoint, "append", trigger)


def trend_so_far(spark: SparkSession, root: str, checkpoint: str) -> DataFrame:
    """All windows of ``chart_closed_windows`` after its last finished batch: closed, late and still open ones."""
    until = finished_batch(spark, checkpoint)
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["key"].dataType.fieldNames()  # the window, then the bucket
    open_ = state.select(
        F.col(f"key.{names[0]}.start").alias("window_start"), F.col(f"key.`{names[1]}`").alias("bucket_start"), F.col("value.count").alias("n")
    )
    for table in (closed_window_table(root), late_window_table(root)):
        open_ = open_.unionByName(table.read(spark, until).drop("date"))
    return open_.groupBy("window_start", "bucket_start").agg(F.sum("n").alias("n"))
