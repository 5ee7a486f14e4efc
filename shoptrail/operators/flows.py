"""Page views and page-to-page steps along a target path."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.operators.filters import is_one_of, is_pair_of


def path_pages(path: str) -> list[str]:
    """Pages of ``'1,2,3'``; empty parts at the end do not count."""
    pages = path.split(",")
    while len(pages) > 1 and pages[-1] == "":
        pages.pop()
    return pages


def path_pairs(path: str) -> list[tuple[str, str]]:
    """Distinct consecutive pages of a path, ``'1,2,3'`` to ``(1,2), (2,3)``."""
    pages = path_pages(path)
    return list(dict.fromkeys(zip(pages, pages[1:])))


def page_views(actions: DataFrame, path: str) -> DataFrame:
    """Views of each page of the path, every action counted."""
    return actions.filter(is_one_of(F.col("page_id"), path_pages(path))).groupBy("page_id").agg(
        F.count("*").alias("views")
    )


def pair_counts(pairs: DataFrame, path: str) -> DataFrame:
    """How often each step of the path was taken; steps never taken are not listed."""
    wanted = is_pair_of(F.col("from_page"), F.col("to_page"), path_pairs(path))
    return pairs.filter(wanted).groupBy("from_page", "to_page").agg(F.count("*").alias("n"))


def with_page_views(counts: DataFrame, views: DataFrame) -> DataFrame:
    """Look up the views of each step's first page; a page without views counts as 1."""
    views = views.select(F.col("page_id").alias("_page"), "views")
    return counts.join(views, F.col("from_page") == F.col("_page"), "left").select(
        *counts.columns, F.coalesce("views", F.lit(1)).alias("views")
    )


def path_steps(followed: DataFrame, path: str) -> DataFrame:
    """``(from_page, to_page, n, views)`` of each step of the path in one pass over the actions.

    Every view of a path page is counted under the path step it begins, or under none; the views of
    a page are the sum of its counts. Pages off the path stay in the sessions until they have been
    followed, so a detour between two path pages is no step.
    """
    step = is_pair_of(F.col("page_id"), F.col("next_page_id"), path_pairs(path))
    taken = followed.filter(is_one_of(F.col("page_id"), path_pages(path))).select(
        F.col("page_id").alias("from_page"), F.when(step, F.col("next_page_id")).alias("to_page")
    )
    counts = taken.groupBy("from_page", "to_page").agg(F.count("*").alias("n"))
    views = F.sum("n").over(Window.partitionBy("from_page"))
    return counts.withColumn("views", views).filter(F.col("to_page").isNotNull())


def conversion_ratio(steps: DataFrame) -> DataFrame:
    """Steps taken per view of the first page."""
    return steps.select("from_page", "to_page", (F.col("n").cast("double") / F.col("views")).alias("ratio"))
