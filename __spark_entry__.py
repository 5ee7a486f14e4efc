"""

Every query reads the whole tables below ``sf_dir``. Visit actions and ad clicks are derived from
``events``, ``nation`` and ``region`` (see ``shoptrail/sources/event_views.py``); the oracles state
the same derivation in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.functions import documents, text, times
from shoptrail.operators import ads, categories, filters, flows, sessions
from shoptrail.plans import ads as ad_plans
from shoptrail.plans import shop
from shoptrail.session import apply_settings, work_folder
from shoptrail.sinks.tables import first_rows, replace_table, written
from shoptrail.sources import clicks as click_source
from shoptrail.sources import event_views, session_tables, sql_text
from shoptrail.sources.tables import table_scan
from shoptrail.streaming import jobs

try:
    from shoptrail.llm import queries as llm
except ModuleNotFoundError as error:
    # The library works without that subpackage; anything else that is missing is an error.
    if error.name not in ("shoptrail.llm", "shoptrail.llm.queries"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries.
PATH = "1,2,3,4,5,6,7"
FIRST_DAY, LAST_DAY = "2024-01-08", "2024-01-21"
MIDDLE = "2024-01-16"
THRESHOLD = 3
AS_OF = "2024-01-15 12:00:00"
RUN = "run-1"
PART_SIZE = 30
TREND = (21600, 3600, 3600)  # seconds: width, slide, bucket


# --- inputs ---------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir}/events.parquet")


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_views.visit_actions(_events(spark, sf_dir))


def _as_clicks(events: DataFrame, sf_dir: str) -> DataFrame:
    read = events.sparkSession.read
    return event_views.ad_clicks(
        events, read.parquet(f"{sf_dir}/nation.parquet"), read.parquet(f"{sf_dir}/region.parquet")
    )


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_clicks(_events(spark, sf_dir), sf_dir)


def _click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream of click lines in three batches or more, parsed again.

    The lines are dealt to files by their hash, so every batch holds clicks of all times and they
    come out of order of arrival.
    """
    lines = event_views.click_lines(_clicks(spark, sf_dir))
    folder = work_folder(spark, "click-lines")
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines.repartition(files, F.xxhash64("value")).write.parquet(folder)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files // 3).parquet(folder)
    return click_source.parse_click_lines(click_source.line_values(stream))


# --- shop queries ---------------------------------------------------------------------------------


def typed_actions(spark, sf_dir):
    """The visits saved as a catalog table of texts, and scanned under their schema."""
    actions = _actions(spark, sf_dir)
    folder = work_folder(spark, "visits")
    name = "shoptrail_visits_" + folder.rsplit("-", 1)[1]
    texts = actions.select(*[F.col(c).cast("string") if c != "event_id" else F.col(c) for c in actions.columns])
    replace_table(texts, name, folder)
    return table_scan(spark, name, keep=["event_id"])


def category_events(spark, sf_dir):
    return categories.category_events(_actions(spark, sf_dir), keep=("event_id",))


def category_counts(spark, sf_dir):
    return categories.category_counts(categories.category_events(_actions(spark, sf_dir)))


def category_top10(spark, sf_dir):
    return shop.category_top10(_actions(spark, sf_dir))


def category_session_top10(spark, sf_dir):
    return shop.category_session_top10(_actions(spark, sf_dir))


def category_top10_run(spark, sf_dir):
    """Rows as they are appended to a result table: with the run's id."""
    return shop.category_top10(_actions(spark, sf_dir), task_id=RUN)


def category_session_top10_run(spark, sf_dir):
    return shop.category_session_top10(_actions(spark, sf_dir), FIRST_DAY, LAST_DAY, task_id=RUN)


def first_actions(spark, sf_dir):
    """The first ten visits, to be shown."""
    return first_rows(_actions(spark, sf_dir).select("event_id", "session_id", "page_id").orderBy("event_id"))


def top_category_clicks_semi(spark, sf_dir):
    actions = _actions(spark, sf_dir)
    clicks = categories.clicks_in(actions, shop.category_top10(actions))
    return clicks.select("event_id", "session_id", "click_category_id")


def product_clicks_semi(spark, sf_dir):
    """Clicks on the larger parts, from a list that may be of any length."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").filter(F.col("p_size") >= PART_SIZE)
    clicks = categories.clicks_on_products(_actions(spark, sf_dir), parts, "p_partkey")
    return clicks.select("event_id", "click_product_id")


def date_range_filter(spark, sf_dir):
    chosen = filters.between_dates(_actions(spark, sf_dir), FIRST_DAY, LAST_DAY)
    return chosen.select("event_id", "date", "session_id")


def not_blank_filter(spark, sf_dir):
    chosen = _actions(spark, sf_dir).filter(text.is_not_blank(F.col("order_category_ids")))
    return chosen.select("event_id", "order_category_ids")


def list_texts(spark, sf_dir):
    """Blank lists, lists of separators and lists that end in some, derived from the events."""
    lists = F.expr(
        r"""CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN '\t\n ' WHEN 3 THEN ',' WHEN 4 THEN concat(user_id, ',,')
        WHEN 5 THEN concat(',', user_id) WHEN 6 THEN concat(user_id, ',,', event_type) END"""
    )
    rows = _events(spark, sf_dir).select("event_id", lists.alias("list"))
    parts = text.split_list(F.col("list"))
    return rows.select(
        "event_id",
        F.coalesce(text.is_not_blank(F.col("list")), F.lit(False)).alias("filled"),
        F.size(parts).alias("parts"),
        F.array_join(parts, "|").alias("joined"),
    )


def page_views(spark, sf_dir):
    return flows.page_views(_actions(spark, sf_dir), PATH)


def _pairs(spark, sf_dir, keep=()):
    followed = sessions.with_next_action(_actions(spark, sf_dir), ["page_id"])
    return sessions.page_pairs(followed, keep)


def session_page_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir, ("session_id", "event_id"))


def page_pair_counts(spark, sf_dir):
    return flows.pair_counts(_pairs(spark, sf_dir), PATH)


def page_view_lookup(spark, sf_dir):
    return flows.with_page_views(page_pair_counts(spark, sf_dir), page_views(spark, sf_dir))


def page_flow_ratio(spark, sf_dir):
    return _rounded(shop.page_flow_ratio(_actions(spark, sf_dir), PATH))


def checkpointed_page_flow(spark, sf_dir):
    """The two-branch form: visit actions are written once, then viewed and followed."""
    columns = ["session_id", "action_time", "page_id", "event_id"]
    actions = written(_actions(spark, sf_dir).select(*columns))
    pairs = sessions.page_pairs(sessions.with_next_action(actions, ["page_id"]))
    steps = flows.with_page_views(flows.pair_counts(pairs, PATH), flows.page_views(actions, PATH))
    return _rounded(flows.conversion_ratio(steps))


def _rounded(ratios):
    pages = [F.col(c).cast("bigint").alias(c) for c in ("from_page", "to_page")]
    return ratios.select(*pages, F.round("ratio", 9).alias("ratio"))


def _stored_sessions(spark, sf_dir):
    folder = work_folder(spark, "sessions")
    name = "shoptrail_sessions_" + folder.rsplit("-", 1)[1]
    session_tables.store_sessions(_actions(spark, sf_dir), name, folder, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return name


def page_flow_ratio_bucketed(spark, sf_dir):
    """The page flow over visits stored by session: no exchange and no sort to follow them."""
    followed = session_tables.next_actions(spark, _stored_sessions(spark, sf_dir), ["page_id"])
    return _rounded(flows.conversion_ratio(flows.path_steps(followed, PATH)))


def page_avg_dwell_bucketed(spark, sf_dir):
    followed = session_tables.next_actions(spark, _stored_sessions(spark, sf_dir), ["action_time"])
    return sessions.mean_dwell(sessions.dwell_times(followed))


def _actions_view(spark, sf_dir):
    name = "shoptrail_actions_view"
    _actions(spark, sf_dir).createOrReplaceTempView(name)
    return name


def date_range_sql(spark, sf_dir):
    """The bounds as parameters of SQL text: both given, the last blank, and none."""
    name, columns = _actions_view(spark, sf_dir), ["event_id", "date", "session_id"]
    parts = []
    for bounds, (start, end) in {"both": (FIRST_DAY, LAST_DAY), "first": (MIDDLE, " \t"), "none": (None, "")}.items():
        chosen = sql_text.actions_between(spark, name, start, end).select(*columns)
        parts.append(chosen.withColumn("bounds", F.lit(bounds)))
    return parts[0].union(parts[1]).union(parts[2])


def category_events_sql(spark, sf_dir):
    """The category events by SQL functions and a lateral explode."""
    return sql_text.category_events(spark, _actions_view(spark, sf_dir))


def props_fields(spark, sf_dir):
    """Fields of the events' documents by type; what is of another type is null."""
    value = documents.document(F.col("props"))
    return _events(spark, sf_dir).select(
        "event_id",
        documents.typed_field(value, "$.k", "int").alias("k"),
        documents.typed_field(value, "$.k", "string").alias("k_text"),
        documents.typed_field(value, "$.k", "date", strict=False).alias("k_day"),
        documents.typed_field(value, "$.none", "int").alias("missing"),
        documents.document_text(value).alias("document"),
    )


def session_dwell(spark, sf_dir):
    followed = sessions.with_next_action(_actions(spark, sf_dir), ["action_time"])
    return sessions.dwell_times(followed, ("session_id", "event_id"))


def page_avg_dwell_ms(spark, sf_dir):
    return shop.page_avg_dwell_ms(_actions(spark, sf_dir))


def text_functions(spark, sf_dir):
    parts = text.split_list(F.col("order_category_ids"))
    return _actions(spark, sf_dir).select(
        "event_id",
        F.coalesce(F.size(parts), F.lit(0)).alias("parts"),
        F.element_at(parts, 1).alias("first_part"),
        F.array_contains(parts, "1").alias("has_one"),
        F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, x: total + x.cast("bigint")).alias("id_sum"),
        F.concat_ws("_", "session_id", F.col("page_id").cast("string")).alias("joined"),
    )


def time_functions(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    ms = F.unix_millis(ts)
    dashed = times.epoch_ms_to_text(ms)
    return _events(spark, sf_dir).select(
        "event_id",
        ms.alias("ms"),
        times.epoch_ms_to_text(ms, times.DAY).alias("day"),
        times.time_to_text(ts).alias("second"),
        dashed.alias("dashed"),
        text.zero_last_character(dashed).alias("bucket"),
        times.text_to_epoch_ms(times.time_to_text(ts)).alias("second_ms"),
        text.json_text_field(F.col("props"), "k").alias("k"),
    )


# --- ad queries -----------------------------------------------------------------------------------


def ad_line_parse(spark, sf_dir):
    lines = event_views.click_lines(_clicks(spark, sf_dir))
    parsed = click_source.parse_click_lines(click_source.line_values(lines))
    return parsed.select(F.unix_millis("ts").alias("ms"), "date", "area", "city", "user_id", "ad_id")


def ad_line_quarantine(spark, sf_dir):
    """Click lines of which every fifth is spoilt: the clicks of the good ones, and the others with the reason."""
    lines = event_views.click_lines(_clicks(spark, sf_dir)).drop("arrival")
    ms = F.substring_index("value", " ", 1).cast("bigint")
    rest = F.expr("substr(value, instr(value, ' ') + 1)")
    spoilt = (
        F.when(ms % 5 != 0, F.col("value"))
        .when(ms % 3 == 0, F.concat(F.lit("noon "), rest))
        .when(ms % 3 == 1, F.concat(F.lit("99999999999999999 "), rest))
        .otherwise(F.substring_index("value", " ", 3))
    )
    good, bad = click_source.sorted_out(lines.select(spoilt.alias("value")))
    none = F.lit(None).cast("string")
    good = good.select(F.unix_millis("ts").alias("ms"), "user_id", "ad_id", none.alias("value"), none.alias("reason"))
    return good.union(bad.select(F.lit(None).cast("bigint"), none, none, "value", "reason"))


def user_ad_day_counts(spark, sf_dir):
    return ads.count_by(_clicks(spark, sf_dir), ads.USER_KEYS)


def heavy_user_ad_days(spark, sf_dir):
    return filters.at_least(user_ad_day_counts(spark, sf_dir), THRESHOLD)


def blacklist(spark, sf_dir):
    return ad_plans.blacklist(_clicks(spark, sf_dir), THRESHOLD)


def blacklist_filtered_clicks(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    kept = ads.drop_banned(clicks, written(ad_plans.blacklist(clicks, THRESHOLD)))
    return kept.select("event_id", "date", "user_id", "ad_id")


def clicks_until_ban(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    heavy = written(heavy_user_ad_days(spark, sf_dir))
    kept = ads.clicks_until_ban(clicks, written(ads.ban_times(clicks, heavy, THRESHOLD)))
    return kept.select("event_id", "date", "user_id", "ad_id")


def ad_city_counts(spark, sf_dir):
    return ad_plans.ad_city_counts(_clicks(spark, sf_dir))


def ad_city_counts_unbanned(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    return ad_plans.ad_city_counts(clicks, ad_plans.blacklist(clicks, THRESHOLD))


def ad_area_rollup(spark, sf_dir):
    return ads.sum_by(ad_city_counts(spark, sf_dir), ads.AREA_KEYS)


def ad_area_top3(spark, sf_dir):
    return ads.top_ads(ads.count_by(_clicks(spark, sf_dir), ads.AREA_KEYS))


def ad_area_top3_json(spark, sf_dir):
    return ad_plans.ad_area_top(_clicks(spark, sf_dir))


def ad_trend(spark, sf_dir):
    return ad_plans.ad_trend(_clicks(spark, sf_dir), AS_OF, TREND[0], TREND[2])


def ad_trend_sliding(spark, sf_dir):
    trend = ads.ad_trend_sliding(_clicks(spark, sf_dir))
    return trend.withColumn("window_start", times.time_to_text(F.col("window_start")))


def ad_trend_window(spark, sf_dir):
    """One window of the sliding trend, as it is shown when the window closes."""
    end = F.to_timestamp(F.lit(AS_OF))
    start = end - F.make_dt_interval(secs=F.lit(TREND[0]))
    clicks = _clicks(spark, sf_dir).filter((F.col("arrival") >= start) & (F.col("arrival") < end))
    return ads.window_report(ads.trend_panes(clicks, *TREND), start, *TREND[:2])


# --- streaming queries ----------------------------------------------------------------------------


def _run(spark, sf_dir, name, job, table, **options):
    """Run a job over all events there are, in several batches, then read the table it keeps."""
    stream = _click_stream(spark, sf_dir)
    root = work_folder(spark, name)
    query = job(stream, f"{root}/tables", f"{root}/checkpoint", trigger=jobs.ALL_AVAILABLE, **options)
    query.awaitTermination()
    return table(f"{root}/tables").read(spark)


def _run_for_state(spark, sf_dir, name, job, **options):
    """Run a job the same way; its folder of tables and its checkpoint."""
    root = work_folder(spark, name)
    places = f"{root}/tables", f"{root}/checkpoint"
    job(_click_stream(spark, sf_dir), *places, trigger=jobs.ALL_AVAILABLE, **options).awaitTermination()
    return places


def stream_user_ad_counts(spark, sf_dir):
    """The running counts, read from the job's state store."""
    return jobs.user_ad_counts(spark, *_run_for_state(spark, sf_dir, "user-ads", jobs.count_user_ads))


def stream_ban_counters(spark, sf_dir):
    """The counters the ban job goes by, read from its state store."""
    _, checkpoint = _run_for_state(spark, sf_dir, "ban-counters", jobs.block_heavy_clickers, threshold=THRESHOLD)
    return jobs.state_counts(spark, checkpoint, ads.USER_KEYS)


def stream_ad_city_counts(spark, sf_dir):
    return _run(spark, sf_dir, "city-ads", jobs.count_city_ads, jobs.city_counter_table)


def stream_ad_area_top3(spark, sf_dir):
    return _run(spark, sf_dir, "area-top", jobs.rank_area_ads, jobs.area_top_table)


def stream_blacklist(spark, sf_dir):
    return _run(spark, sf_dir, "blacklist", jobs.block_heavy_clickers, jobs.banned_table, threshold=THRESHOLD)


def stream_ad_trend(spark, sf_dir):
    windows = ads.trend_windows(_run(spark, sf_dir, "trend", jobs.chart_trend, jobs.trend_table))
    start, bucket = times.time_to_text(F.col("window_start")), ads.bucket_label(F.col("bucket_start"))
    return windows.select(start.alias("window_start"), bucket.alias("bucket"), "n")


def stream_trend_closed(spark, sf_dir):
    """The trend under a watermark: closed, late and open windows; the clicks come out of order, so many are late."""
    places = _run_for_state(spark, sf_dir, "closed-windows", jobs.chart_closed_windows, delay="1 hour")
    start, bucket = times.time_to_text(F.col("window_start")), ads.bucket_label(F.col("bucket_start"))
    return jobs.trend_so_far(spark, *places).select(start.alias("window_start"), bucket.alias("bucket"), "n")


# --- tables that batches keep, and sinks -----------------------------------------------------------------------


def counter_merge(spark, sf_dir):
    """Clicks added to counters in two batches, the first of them twice."""
    clicks = _clicks(spark, sf_dir)
    table = jobs.city_counter_table(work_folder(spark, "counter-merge"))
    early = ads.count_by(filters.between_dates(clicks, end=MIDDLE), ads.CITY_KEYS)
    late = ads.count_by(clicks.filter(F.col("date") > MIDDLE), ads.CITY_KEYS)
    table.put(early, 0)
    table.put(early, 0)
    table.put(late, 1)
    return table.read(spark)


def set_insert(spark, sf_dir):
    """Banned users of the first days, then of all days, put into one set."""
    clicks = _clicks(spark, sf_dir)
    table = jobs.banned_table(work_folder(spark, "set-insert"))
    table.put(ad_plans.blacklist(filters.between_dates(clicks, end=MIDDLE), THRESHOLD), 0)
    table.put(ad_plans.blacklist(clicks, THRESHOLD), 1)
    return table.read(spark)


def keyed_replace(spark, sf_dir):
    """The best ad of each day and area, replaced by the best three."""
    clicks = _clicks(spark, sf_dir)
    table = jobs.area_top_table(work_folder(spark, "keyed-replace"))
    table.put(ad_plans.ad_area_top(clicks, k=1), 0)
    table.put(ad_plans.ad_area_top(clicks), 1)
    return table.read(spark)


def table_replace(spark, sf_dir):
    """A result table written, replaced by another result, and read back from the catalog."""
    counts = category_counts(spark, sf_dir)
    folder = work_folder(spark, "table-replace")
    name = "shoptrail_" + folder.rsplit("-", 1)[1]
    replace_table(counts.filter(F.col("click_count") > 0).select("category_id"), name, f"{folder}/first")
    return replace_table(counts, name, f"{folder}/second")


_QUERIES = [
    typed_actions,
    category_events,
    category_counts,
    category_top10,
    category_session_top10,
    category_top10_run,
    category_session_top10_run,
    first_actions,
    top_category_clicks_semi,
    product_clicks_semi,
    date_range_filter,
    not_blank_filter,
    list_texts,
    page_views,
    session_page_pairs,
    page_pair_counts,
    page_view_lookup,
    page_flow_ratio,
    checkpointed_page_flow,
    page_flow_ratio_bucketed,
    page_avg_dwell_bucketed,
    date_range_sql,
    category_events_sql,
    props_fields,
    session_dwell,
    page_avg_dwell_ms,
    text_functions,
    time_functions,
    ad_line_parse,
    ad_line_quarantine,
    user_ad_day_counts,
    heavy_user_ad_days,
    blacklist,
    blacklist_filtered_clicks,
    clicks_until_ban,
    ad_city_counts,
    ad_city_counts_unbanned,
    ad_area_rollup,
    ad_area_top3,
    ad_area_top3_json,
    ad_trend,
    ad_trend_sliding,
    ad_trend_window,
    stream_user_ad_counts,
    stream_ban_counters,
    stream_ad_city_counts,
    stream_ad_area_top3,
    stream_blacklist,
    stream_ad_trend,
    stream_trend_closed,
    counter_merge,
    set_insert,
    keyed_replace,
    table_replace,
]


def entry(spark: SparkSession) -> DataFrame:
    """Top-10 categories on the smallest tables."""
    return category_top10(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    return {query.__name__: query for query in [*_QUERIES, *(llm.QUERIES if llm else ())]}


# --- oracles --------------------------------------------------------------------------------------

_EV = """ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, substr(CAST(ts AS VARCHAR), 1, 19) AS tm
  FROM events)"""

_UVA = """uva AS (
  SELECT dt AS date, user_id, concat('s', CAST(user_id AS VARCHAR), '-', dt) AS session_id,
    CAST(k % 10 + 1 AS BIGINT) AS page_id, tm AS action_time,
    CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 6 AS VARCHAR)) END AS search_keyword,
    CAST(CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS BIGINT) AS click_category_id,
    CAST(CASE WHEN event_type = 'click' THEN event_id % 100 + 1 ELSE -1 END AS BIGINT) AS click_product_id,
    CASE WHEN event_type = 'signup' OR (event_type = 'purchase' AND k % 10 = 0)
      THEN concat(CAST(k % 20 + 1 AS VARCHAR), ',', CAST((k * 3) % 20 + 1 AS VARCHAR), ',',
                  CAST((k * 7) % 20 + 1 AS VARCHAR)) END AS order_category_ids,
    CAST(NULL AS VARCHAR) AS order_product_ids,
    CASE WHEN event_type = 'purchase'
      THEN concat(CAST((k + 5) % 20 + 1 AS VARCHAR), ',', CAST((k * 3 + 5) % 20 + 1 AS VARCHAR))
      END AS pay_category_ids,
    CAST(NULL AS VARCHAR) AS pay_product_ids,
    CAST(user_id % 25 AS BIGINT) AS city_id, event_id
  FROM ev)"""

_ADS = """ads AS (
  SELECT ts, dt AS date, replace(r_name, ' ', '-') AS area, n_name AS city,
    CAST(user_id AS VARCHAR) AS user_id, CAST(k % 6 + 1 AS VARCHAR) AS ad_id,
    ts + k * INTERVAL 1 SECOND AS arrival, event_id
  FROM ev JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CATEGORY = """kinds AS (
  SELECT event_id, CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind
  FROM uva WHERE click_category_id <> -1
  UNION ALL
  SELECT event_id, unnest(string_split(order_category_ids, ',')), 'order'
  FROM uva WHERE click_category_id = -1 AND order_category_ids IS NOT NULL
  UNION ALL
  SELECT event_id, unnest(string_split(pay_category_ids, ',')), 'pay'
  FROM uva WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL),
counts AS (
  SELECT category_id, CAST(sum(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click_count,
    CAST(sum(CASE WHEN kind = 'order' THEN 1 ELSE 0 END) AS BIGINT) AS order_count,
    CAST(sum(CASE WHEN kind = 'pay' THEN 1 ELSE 0 END) AS BIGINT) AS pay_count
  FROM kinds GROUP BY category_id),
top10 AS (
  SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)"""

_FOLLOWED = """followed AS (
  SELECT session_id, event_id, page_id, action_time,
    lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_page,
    lead(action_time) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_time
  FROM uva),
views AS (SELECT page_id, count(*) AS views FROM uva WHERE page_id BETWEEN 1 AND 7 GROUP BY page_id),
steps AS (
  SELECT page_id AS from_page, next_page AS to_page, count(*) AS n
  FROM followed WHERE next_page = page_id + 1 AND page_id BETWEEN 1 AND 6 GROUP BY page_id, next_page),
dwell AS (
  SELECT session_id, event_id, page_id, CAST((epoch_us(CAST(next_time AS TIMESTAMP))
    - epoch_us(CAST(action_time AS TIMESTAMP))) // 1000 AS BIGINT) AS ms
  FROM followed WHERE next_time IS NOT NULL)"""

_AREA_TOP = """area_counts AS (SELECT date, area, ad_id, count(*) AS n FROM ads GROUP BY date, area, ad_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY date, area ORDER BY n DESC, ad_id) AS INT) AS rank
  FROM area_counts),
area_json AS (
  SELECT date, area, '{' || string_agg('"' || ad_id || '":' || CAST(n AS VARCHAR), ',' ORDER BY rank) || '}'
    AS top_ads
  FROM ranked WHERE rank <= 3 GROUP BY date, area)"""

_BANS = f"""user_counts AS (SELECT date, ad_id, user_id, count(*) AS n FROM ads GROUP BY date, ad_id, user_id),
banned AS (SELECT DISTINCT user_id FROM user_counts WHERE n >= {THRESHOLD})"""

_SLIDING = """panes AS (
  SELECT epoch_us(arrival) // 10000000 AS pane, epoch_us(ts) // 10000000 AS bucket, count(*) AS n
  FROM ads GROUP BY ALL),
windows AS (
  SELECT pane - back AS w, bucket, sum(n) AS n
  FROM panes, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS back) GROUP BY ALL),
sliding AS (
  SELECT strftime(make_timestamp(CAST(w * 10000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(make_timestamp(CAST(bucket * 10000000 AS BIGINT)), '%Y-%m-%d %H-%M-%S') AS bucket,
    CAST(n AS BIGINT) AS n
  FROM windows)"""


def _shop_sql(select: str, *views: str) -> str:
    """``select`` over the named views; it may open with further views after a comma."""
    return f"WITH {', '.join([_EV, _UVA, *views])} {select}"


def _ads_sql(select: str, *views: str) -> str:
    return f"WITH {', '.join([_EV, _ADS, *views])} {select}"


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, for every registered query."""
    city_counts = _ads_sql("SELECT date, area, city, ad_id, count(*) AS n FROM ads GROUP BY date, area, city, ad_id")
    area_json = _ads_sql("SELECT * FROM area_json", _AREA_TOP)
    user_counts = _ads_sql("SELECT * FROM user_counts", _BANS)
    banned = _ads_sql("SELECT * FROM banned", _BANS)
    counts = _shop_sql("SELECT * FROM counts", _CATEGORY)
    ratio = _shop_sql(
        """SELECT from_page, to_page, round(CAST(n AS DOUBLE) / coalesce(views, 1), 9) AS ratio
        FROM steps LEFT JOIN views ON from_page = page_id""",
        _FOLLOWED,
    )
    dwell = _shop_sql("SELECT page_id, CAST(sum(ms) // count(*) AS BIGINT) AS avg_ms FROM dwell GROUP BY page_id", _FOLLOWED)
    sliding = _ads_sql("SELECT * FROM sliding", _SLIDING)
    trend = _ads_sql(
        f"""SELECT strftime(time_bucket(INTERVAL {TREND[2]} SECOND, ts), '%Y-%m-%d %H-%M-%S') AS bucket,
          count(*) AS n
        FROM ads WHERE arrival >= TIMESTAMP '{AS_OF}' - INTERVAL {TREND[0]} SECOND
          AND arrival < TIMESTAMP '{AS_OF}' GROUP BY 1"""
    )
    oracles = {
        "typed_actions": _shop_sql("SELECT * FROM uva"),
        "category_events": _shop_sql("SELECT * FROM kinds", _CATEGORY),
        "category_counts": counts,
        "category_top10": _shop_sql("SELECT * FROM top10", _CATEGORY),
        "category_top10_run": _shop_sql(f"""SELECT '{RUN}' AS "taskId", * FROM top10""", _CATEGORY),
        "category_session_top10_run": _shop_sql(
            f""", clicks AS (
              SELECT CAST(click_category_id AS VARCHAR) AS c, session_id, count(*) AS n FROM uva
              WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10) GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, session_id) AS rn FROM clicks)
            SELECT '{RUN}' AS "taskId", c AS "categoryId", session_id AS "sessionId", n AS "clickCount" FROM r WHERE rn <= 10""",
            _CATEGORY,
        ).replace("FROM ev)", f"FROM ev WHERE dt BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}')", 1),
        "first_actions": _shop_sql("SELECT event_id, session_id, page_id FROM uva ORDER BY event_id LIMIT 10"),
        "category_session_top10": _shop_sql(
            """, clicks AS (
              SELECT CAST(click_category_id AS VARCHAR) AS c, session_id, count(*) AS n FROM uva
              WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10) GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, session_id) AS rn FROM clicks)
            SELECT c AS "categoryId", session_id AS "sessionId", n AS "clickCount" FROM r WHERE rn <= 10""",
            _CATEGORY,
        ),
        "top_category_clicks_semi": _shop_sql(
            """SELECT event_id, session_id, click_category_id FROM uva
            WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)""",
            _CATEGORY,
        ),
        "product_clicks_semi": _shop_sql(
            f"""SELECT event_id, click_product_id FROM uva
            WHERE click_product_id IN (SELECT p_partkey FROM part WHERE p_size >= {PART_SIZE})"""
        ),
        "date_range_filter": _shop_sql(
            f"SELECT event_id, date, session_id FROM uva WHERE date BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}'"
        ),
        "not_blank_filter": _shop_sql(
            "SELECT event_id, order_category_ids FROM uva WHERE order_category_ids IS NOT NULL"
        ),
        "list_texts": """
            SELECT event_id, event_id % 8 IN (3, 4, 5, 6) AS filled,
              CAST(CASE event_id % 8 WHEN 3 THEN 0 WHEN 5 THEN 2 WHEN 6 THEN 3 WHEN 7 THEN NULL ELSE 1 END AS INT) AS parts,
              CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN concat(chr(9), chr(10), ' ') WHEN 3 THEN ''
                WHEN 4 THEN CAST(user_id AS VARCHAR) WHEN 5 THEN concat('|', user_id)
                WHEN 6 THEN concat(user_id, '||', event_type) END AS joined
            FROM events""",
        "page_views": _shop_sql("SELECT * FROM views", _FOLLOWED),
        "session_page_pairs": _shop_sql(
            """SELECT session_id, event_id, page_id AS from_page, next_page AS to_page
            FROM followed WHERE next_page IS NOT NULL""",
            _FOLLOWED,
        ),
        "page_pair_counts": _shop_sql("SELECT * FROM steps", _FOLLOWED),
        "page_view_lookup": _shop_sql(
            """SELECT from_page, to_page, n, coalesce(views, 1) AS views
            FROM steps LEFT JOIN views ON from_page = page_id""",
            _FOLLOWED,
        ),
        "page_flow_ratio": ratio,
        "checkpointed_page_flow": ratio,
        "page_flow_ratio_bucketed": ratio,
        "date_range_sql": _shop_sql(
            f"""SELECT event_id, date, session_id, 'both' AS bounds FROM uva WHERE date BETWEEN '{FIRST_DAY}' AND '{LAST_DAY}'
            UNION ALL SELECT event_id, date, session_id, 'first' FROM uva WHERE date >= '{MIDDLE}'
            UNION ALL SELECT event_id, date, session_id, 'none' FROM uva"""
        ),
        "category_events_sql": _shop_sql("SELECT * FROM kinds", _CATEGORY),
        "props_fields": """SELECT event_id, CAST(props->>'$.k' AS INT) AS k, props->>'$.k' AS k_text,
            CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN TRY_CAST(props->>'$.k' AS DATE) END AS k_day,
            CAST(props->>'$.none' AS INT) AS missing, CAST(json(props) AS VARCHAR) AS document FROM events""",
        "session_dwell": _shop_sql("SELECT * FROM dwell", _FOLLOWED),
        "page_avg_dwell_ms": dwell,
        "page_avg_dwell_bucketed": dwell,
        "text_functions": _shop_sql(
            """, parts AS (SELECT *, string_split(order_category_ids, ',') AS p FROM uva)
            SELECT event_id, CAST(coalesce(len(p), 0) AS INT) AS parts, p[1] AS first_part,
              list_contains(p, '1') AS has_one,
              CAST(list_sum(list_transform(p, lambda x: CAST(x AS BIGINT))) AS BIGINT) AS id_sum,
              session_id || '_' || CAST(page_id AS VARCHAR) AS joined
            FROM parts"""
        ),
        "time_functions": f"""WITH {_EV}
            SELECT event_id, epoch_us(ts) // 1000 AS ms, dt AS day, tm AS second,
              strftime(ts, '%Y-%m-%d %H-%M-%S') AS dashed,
              substr(strftime(ts, '%Y-%m-%d %H-%M-%S'), 1, 18) || '0' AS bucket,
              epoch_us(ts) // 1000000 * 1000 AS second_ms, CAST(k AS VARCHAR) AS k
            FROM ev""",
        "ad_line_parse": _ads_sql("SELECT epoch_us(ts) // 1000 AS ms, date, area, city, user_id, ad_id FROM ads"),
        "ad_line_quarantine": _ads_sql(
            """, lines AS (SELECT epoch_us(ts) // 1000 AS ms, concat_ws(' ', area, city, user_id, ad_id) AS rest, area, city, user_id, ad_id FROM ads)
            SELECT ms, user_id, ad_id, NULL AS value, NULL AS reason FROM lines WHERE ms % 5 <> 0
            UNION ALL SELECT NULL, NULL, NULL, CASE ms % 3 WHEN 0 THEN 'noon ' || rest WHEN 1 THEN '99999999999999999 ' || rest
                ELSE list_aggregate((string_split(CAST(ms AS VARCHAR) || ' ' || rest, ' '))[:3], 'string_agg', ' ') END,
              CASE ms % 3 WHEN 0 THEN 'the time is no number' WHEN 1 THEN 'the time is out of range' ELSE 'too few fields' END
            FROM lines WHERE ms % 5 = 0"""
        ),
        "user_ad_day_counts": user_counts,
        "heavy_user_ad_days": _ads_sql(f"SELECT * FROM user_counts WHERE n >= {THRESHOLD}", _BANS),
        "blacklist": banned,
        "blacklist_filtered_clicks": _ads_sql(
            """SELECT event_id, date, user_id, ad_id FROM ads
            WHERE NOT EXISTS (SELECT 1 FROM banned WHERE banned.user_id = ads.user_id)""",
            _BANS,
        ),
        "clicks_until_ban": _ads_sql(
            f""", nth AS (
              SELECT user_id, ts, event_id,
                row_number() OVER (PARTITION BY date, ad_id, user_id ORDER BY ts, event_id) AS rn
              FROM ads),
            crossing AS (
              SELECT user_id, ts AS ban_ts, event_id AS ban_id,
                row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first
              FROM nth WHERE rn = {THRESHOLD})
            SELECT a.event_id, a.date, a.user_id, a.ad_id
            FROM ads a LEFT JOIN (SELECT * FROM crossing WHERE first = 1) b ON a.user_id = b.user_id
            WHERE b.user_id IS NULL OR a.ts < b.ban_ts OR (a.ts = b.ban_ts AND a.event_id <= b.ban_id)"""
        ),
        "ad_city_counts": city_counts,
        "ad_city_counts_unbanned": _ads_sql(
            """SELECT date, area, city, ad_id, count(*) AS n FROM ads
            WHERE user_id NOT IN (SELECT user_id FROM banned) GROUP BY date, area, city, ad_id""",
            _BANS,
        ),
        "ad_area_rollup": _ads_sql("SELECT * FROM area_counts", _AREA_TOP),
        "ad_area_top3": _ads_sql("SELECT * FROM ranked WHERE rank <= 3", _AREA_TOP),
        "ad_area_top3_json": area_json,
        "ad_trend": trend,
        "ad_trend_window": trend,
        "ad_trend_sliding": sliding,
        "stream_user_ad_counts": user_counts,
        "stream_ban_counters": user_counts,
        "stream_ad_city_counts": city_counts,
        "stream_ad_area_top3": area_json,
        "stream_blacklist": banned,
        "stream_ad_trend": sliding,
        "stream_trend_closed": sliding,
        "counter_merge": city_counts,
        "set_insert": banned,
        "keyed_replace": area_json,
        "table_replace": counts,
    }
    return oracles | (llm.ORACLES if llm else {})
