"""The batch queries over ``user_visit_action``."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.operators import categories, flows, sessions
from shoptrail.operators.filters import between_dates


def category_top10(
    actions: DataFrame, start: str | None = None, end: str | None = None, k: int = 10, task_id: str | None = None
) -> DataFrame:
    """The hottest categories by clicks, orders and pays; ``task_id`` adds the run's ``taskId``."""
    events = categories.category_events(between_dates(actions, start, end))
    top = categories.hottest(categories.category_counts(events), k)
    return _with_task(top, task_id)


def category_session_top10(
    actions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    k: int = 10,
    n: int = 10,
    task_id: str | None = None,
) -> DataFrame:
    """The ``n`` sessions that click most in each of the ``k`` hottest categories."""
    chosen = between_dates(actions, start, end)
    clicks = categories.clicks_in(chosen, category_top10(chosen, k=k))
    top = categories.top_sessions(categories.session_clicks(clicks), n)
    result = top.select(
        F.col("category_id").alias("categoryId"),
        F.col("session_id").alias("sessionId"),
        F.col("click_count").alias("clickCount"),
    )
    return _with_task(result, task_id)


def page_flow_ratio(
    actions: DataFrame,
    path: str,
    start: str | None = None,
    end: str | None = None,
    ties: tuple[str, ...] = ("event_id",),
    hot_rows: int | None = sessions.HOT_ROWS,
) -> DataFrame:
    """Share of the views of each page of the path that go on to the path's next page."""
    chosen = between_dates(actions, start, end).select("session_id", "action_time", "page_id", *ties)
    followed = sessions.with_next_action(chosen, ["page_id"], ties=ties, hot_rows=hot_rows)
    return flows.conversion_ratio(flows.path_steps(followed, path))


def page_avg_dwell_ms(
    actions: DataFrame,
    start: str | None = None,
    end: str | None = None,
    ties: tuple[str, ...] = ("event_id",),
    hot_rows: int | None = sessions.HOT_ROWS,
) -> DataFrame:
    """Mean time until the session's next action, per page, in whole milliseconds."""
    chosen = between_dates(actions, start, end).select("session_id", "action_time", "page_id", *ties)
    followed = sessions.with_next_action(chosen, ["action_time"], ties=ties, hot_rows=hot_rows)
    return sessions.mean_dwell(sessions.dwell_times(followed))


def _with_task(result: DataFrame, task_id: str | None) -> DataFrame:
    return result if task_id is None else result.select(F.lit(task_id).alias("taskId"), "*")
