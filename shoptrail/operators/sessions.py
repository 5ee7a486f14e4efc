"""The next action of a session, safe against one session that holds much of the table.

A window over ``session_id`` sorts a session in one task. That is right for people's sessions, but
a crawler or an empty id can hold a third of the rows. Such sessions are found first and followed
in slices of one second; only the first row of each slice takes part in the step across slices.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.times import text_to_epoch_ms

HOT_ROWS = 1_000_000

# Session ids are hashed into so many slots. A session of more than 2/SLOTS of all rows is always
# found, and the list of hot slots has fewer than SLOTS/2 rows whatever the table holds.
SLOTS = 1 << 18


def _slot(session: str, slots: int) -> str:
    return f"pmod(xxhash64({session}), {slots})"


def hot_slots(
    actions: DataFrame, session: str = "session_id", hot_rows: int = HOT_ROWS, slots: int = SLOTS
) -> DataFrame:
    """Hash slots of session ids that hold at least ``hot_rows`` rows and twice the mean of all slots.

    A hot session makes its slot hot. The counts are exact, and a map task sends one number per
    slot. The list only decides how rows are laid out: other sessions of a hot slot go the same way
    and have the same result.
    """
    counts = actions.groupBy(F.expr(f"{_slot(session, slots)} AS slot")).agg(F.count("*").alias("n"))
    mean = counts.selectExpr("slot", "n", f"sum(n) OVER (PARTITION BY 0) / {slots} AS mean")
    return mean.filter(f"n >= {hot_rows} AND n >= 2 * mean").select("slot")


def _lead(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    follow = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return rows.selectExpr(
        "*",
        *[f"lead({v}) {follow} AS next_{v}" for v in values],
        f"lead(true, 1, false) {follow} AS has_next",
    )


def _across_slices(
    rows: DataFrame, keys: Sequence[str], slices: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Follow the last row of each slice by the first row of the next slice of the same ``keys``.

    ``slices`` name columns that cut ``keys`` along ``order``, coarse to fine. Each slice is reduced
    to its first row before any window runs, and the first rows are followed the same way one level
    up, so no window sees more rows than the slices of one level. The result has one row per finest
    slice: ``_after_<value>`` and ``_after``.
    """
    *coarse, fine = slices
    columns = list(dict.fromkeys([*order, *values]))
    first = F.expr(f"min(struct({', '.join(columns)})) AS first")
    heads = rows.groupBy(*keys, *coarse, fine).agg(first).select(*keys, *coarse, fine, "first.*")
    inside = _lead(heads, [*keys, *coarse[-1:]], order, values)
    if coarse:
        inside = _step_across(inside, _across_slices(heads, keys, coarse, order, values), [*keys, coarse[-1]], values)
    return inside.selectExpr(*keys, fine, *[f"next_{v} AS _after_{v}" for v in values], "has_next AS _after")


def _step_across(inside: DataFrame, across: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Give rows without a successor in their slice the one that ``across`` holds for the slice."""
    columns = [c for c in inside.columns if c != "has_next" and c not in {f"next_{v}" for v in values}]
    after = across.select(*on, *[f"_after_{v}" for v in values], "_after")
    return inside.join(after, [*on], "left").selectExpr(
        *columns,
        *[f"if(has_next, next_{v}, _after_{v}) AS next_{v}" for v in values],
        "has_next OR coalesce(_after, false) AS has_next",
    )


def with_next_action(
    actions: DataFrame,
    values: Sequence[str] = ("page_id", "action_time"),
    session: str = "session_id",
    time: str = "action_time",
    ties: Sequence[str] = ("event_id",),
    hot_rows: int | None = HOT_ROWS,
    slots: int = SLOTS,
) -> DataFrame:
    """Each action with ``next_<value>`` of the action after it in its session, and ``has_next``.

    Actions follow by ``time`` as text and by ``ties`` among equal times. A table without an id can
    name the columns it reads, for instance ``ties=["page_id"]``: rows equal in all of them are
    interchangeable. ``hot_rows=None`` skips the search for hot sessions.

    The actions are shuffled once, by session and slice; a usual session is one slice. Where no
    session is hot, the step across slices has no input and adaptive execution leaves it out.
    """
    order = [time, *ties]
    if hot_rows is None:
        return _lead(actions, [session], order, values)

    hot = F.broadcast(hot_slots(actions, session, hot_rows, slots).selectExpr("slot", "true AS _hot"))
    # Actions without a session id make up one session too. Their slices bear a mark, so that a
    # plain equality of session and slice can tell them from the empty id.
    marked = (
        actions.join(hot, F.expr(f"{_slot(session, slots)} = slot"), "left")
        .selectExpr(
            "*",
            f"coalesce({session}, '') AS _session",
            f"if({session} IS NULL, '-', '') AS _mark",
            f"coalesce({time}, '') AS _second",
        )
        .selectExpr("*", "concat(_mark, if(_hot, _second, '')) AS _slice", "substr(_second, 1, 10) AS _day")
    )
    across = _across_slices(marked.filter("_hot"), ["_session", "_mark"], ["_day", "_slice"], order, values)
    inside = _lead(marked.select(*actions.columns, "_session", "_slice"), ["_session", "_slice"], order, values)
    return _step_across(inside, across, ["_session", "_slice"], values).drop("_session", "_slice")


def page_pairs(followed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(from_page, to_page)`` of every action that has a successor."""
    return followed.filter("has_next").select(
        *keep, F.col("page_id").alias("from_page"), F.col("next_page_id").alias("to_page")
    )


def dwell_times(followed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Milliseconds until the next action of the session; the last action has none."""
    ms = text_to_epoch_ms(F.col("next_action_time")) - text_to_epoch_ms(F.col("action_time"))
    return followed.filter("has_next").select(*keep, "page_id", ms.alias("ms"))


def mean_dwell(dwell: DataFrame) -> DataFrame:
    """Mean dwell of each page in whole milliseconds, truncated."""
    return dwell.groupBy("page_id").agg(F.expr("sum(ms) div count(ms)").alias("avg_ms"))
