"""Category events and their counts."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.functions.text import is_not_blank, split_list
from shoptrail.operators.filters import is_click
from shoptrail.operators.ranking import top_per_group, top_rows


def category_events(actions: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One ``(category_id, kind)`` row per category an action touches.

    An action counts once, by the first that applies: its click, its order list, its pay list. An
    order list that is not blank but holds no id (``','``) yields nothing and does not fall through.
    Repeats inside a list count each.
    """
    click = is_click(F.col("click_category_id"))
    order = is_not_blank(F.col("order_category_ids"))
    pay = is_not_blank(F.col("pay_category_ids"))
    kind = F.when(click, "click").when(order, "order").when(pay, "pay")
    categories = (
        F.when(click, F.array(F.col("click_category_id").cast("string")))
        .when(order, split_list(F.col("order_category_ids")))
        .when(pay, split_list(F.col("pay_category_ids")))
    )
    return actions.select(*keep, kind.alias("kind"), F.explode(categories).alias("category_id"))


def category_counts(events: DataFrame) -> DataFrame:
    """Clicks, orders and pays of each category, 0 where there are none."""
    kind = F.col("kind")
    return events.groupBy("category_id").agg(
        F.count_if(kind == "click").alias("click_count"),
        F.count_if(kind == "order").alias("order_count"),
        F.count_if(kind == "pay").alias("pay_count"),
    )


def hottest(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top categories by clicks, then orders, then pays, then id."""
    order = [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]
    return top_rows(counts, order, k)


def clicks_in(actions: DataFrame, categories: DataFrame) -> DataFrame:
    """The click actions whose category is listed in ``categories``.

    Spark broadcasts the list when its measured size allows it. A click on a listed category is the
    only row that can match, so the ``-1`` rows are dropped before.
    """
    wanted = categories.select(F.col("category_id").alias("_wanted"))
    clicks = actions.filter(is_click(F.col("click_category_id")))
    return clicks.join(wanted, F.col("click_category_id").cast("string") == F.col("_wanted"), "left_semi")


def clicks_on_products(actions: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """The click actions on a product of the list ``products``, however long that is.

    A short list is broadcast. For a longer one both sides are shuffled; where the list is filtered and the actions are
    large (``session.SESSION_SETTINGS``), Spark makes a Bloom filter of it first, so that few other actions are.
    """
    wanted = products.select(F.col(key).alias("_product"))
    clicks = actions.filter(F.col("click_product_id") != -1)
    return clicks.join(wanted, F.col("click_product_id") == F.col("_product"), "left_semi")


def session_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks of each session on each category."""
    category = F.col("click_category_id").cast("string").alias("category_id")
    return clicks.groupBy(category, "session_id").agg(F.count("*").alias("click_count"))


def top_sessions(counts: DataFrame, n: int = 10) -> DataFrame:
    """The sessions with most clicks in each category; equal counts by session id."""
    return top_per_group(counts, ["category_id"], [F.desc("click_count"), F.asc("session_id")], n)


def new_task_id() -> str:
    """A run id for result tables. Pass it on as a value: a retried task must not draw another."""
    return str(uuid.uuid4())
