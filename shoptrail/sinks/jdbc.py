"""Result tables in a database."""

from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str] = {}, batch_size: int = 1000, connections: int = 8
) -> dict[str, str]:
    """Writer options: rows per round trip, and how many partitions write at once."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **properties,
    }


def append_jdbc(result: DataFrame, url: str, table: str, properties: Mapping[str, str] = {}, **tuning: int) -> None:
    """Append rows over one connection per partition.

    Driver class, user and password come in ``properties``. A partition commits as a whole; rows of
    a run carry its ``taskId``, by which a reader can drop a run that failed half-way.
    """
    result.write.format("jdbc").mode("append").options(**jdbc_options(url, table, properties, **tuning)).save()
