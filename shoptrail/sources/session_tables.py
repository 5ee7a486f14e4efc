"""Visit actions stored for the queries that follow sessions: bucketed and sorted by session.

A scan of such a table has every session together and in order, so following it takes neither an exchange nor a sort. A
session that holds much of the table would make one bucket, and one task, of it: the rows of hot slots are stored in a
second table, and followed in slices.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.operators import sessions

HOT = "_hot"


def store_sessions(
    actions: DataFrame, name: str, path: str, buckets: int, session: str = "session_id", time: str = "action_time",
    ties: Sequence[str] = ("event_id",), hot_rows: int = sessions.HOT_ROWS, slots: int = sessions.SLOTS,
) -> None:
    """Save ``actions`` as catalog table ``name``, and those of hot sessions as ``name_hot``, in folders below ``path``.

    Both replace older tables of these names. Choose ``buckets`` so that one fits a task; each is one file, in order of
    session, ``time`` and ``ties``.
    """
    spark = actions.sparkSession
    hot = sessions.hot_slots(actions, session, hot_rows, slots).withColumn("_hot", F.lit(True))
    marked = actions.join(F.broadcast(hot), F.expr(f"{sessions._slot(session, slots)} = slot"), "left").drop("slot")
    for table in (name, name + HOT):
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": table})
    # Partitions are dealt as buckets are, so each task writes one file.
    usual = marked.filter("_hot IS NULL").drop("_hot").repartition(buckets, session)
    writer = usual.write.bucketBy(buckets, session).sortBy(session, time, *ties).mode("overwrite")
    writer.option("path", f"{path}/usual").saveAsTable(name)
    marked.filter("_hot").drop("_hot").write.mode("overwrite").option("path", f"{path}/hot").saveAsTable(name + HOT)


def next_actions(
    spark: SparkSession, name: str, values: Sequence[str], session: str = "session_id", time: str = "action_time",
    ties: Sequence[str] = ("event_id",),
) -> DataFrame:
    """The stored actions with ``next_<value>`` and ``has_next``, as ``sessions.with_next_action`` gives them."""
    columns = list(dict.fromkeys([session, time, *ties, "page_id", *values]))
    usual = sessions.with_next_action(spark.table(name).select(*columns), values, session, time, ties, hot_rows=None)
    hot = spark.table(name + HOT).select(*columns)
    if hot.isEmpty():
        return usual
    # All of them are hot: every session is cut into slices.
    followed = sessions.with_next_action(hot, values, session, time, ties, hot_rows=0, slots=1)
    return usual.unionByName(followed)
