"""Top rows of a table and of each group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(table: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of the whole table; every task keeps only its own first ``k``."""
    return table.orderBy(*order).limit(k)


def top_per_group(
    table: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank", parts: int = 64
) -> DataFrame:
    """The first ``k`` rows of each group with their rank.

    ``order`` has to be total within a group, else ties are arbitrary. Below the session's group-limit
    threshold Spark cuts every group to ``k`` rows in each map task, before the shuffle. For a larger
    ``k`` the group is first ranked in ``parts`` parts, so that no task sorts a whole hot group; choose
    ``parts`` so that a part of the largest group fits one task.
    """
    limit = int(table.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in table.columns]), F.lit(parts))
        own = Window.partitionBy(*group, "_part").orderBy(*order)
        table = (
            table.withColumn("_part", part)
            .withColumn(rank, F.row_number().over(own))
            .filter(F.col(rank) <= k)
            .drop("_part", rank)
        )
    ranks = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return table.withColumn(rank, ranks).filter(F.col(rank) <= k)
