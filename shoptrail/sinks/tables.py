"""Catalog tables and materialized intermediate results."""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shoptrail.session import work_folder


# The property of a view that names the table behind it.
BEHIND = "shoptrail.table"


def replace_table(
    result: DataFrame, name: str, path: str | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Save ``result`` under the catalog name ``name``, whatever was there before, and return it.

    ``name`` is a view of a table of its own name and a number. A new table is written first, then the view is
    pointed at it in one step, and the old table goes; so there is a whole table at any time, a failed write leaves the
    old one, and ``result`` may read from it. A plain table of that name is replaced by the view.
    ``path`` puts the files in a folder of the caller's, which must not be the old table's.
    Partitioning visit actions by ``date`` lets date bounds skip folders.
    """
    spark = result.sparkSession
    fresh = f"{name}__{uuid.uuid4().hex}"
    writer = result.write.format("parquet").partitionBy(*partition_by)
    if path is not None:
        writer = writer.mode("overwrite").option("path", path)
    try:
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    old, plain = _behind(spark, name)
    if plain:
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{BEHIND}' = '{fresh}') AS SELECT * FROM {fresh}")
    if old:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove what ``replace_table`` has saved under a name; nothing happens if there is none."""
    old, plain = _behind(spark, name)
    if plain:
        spark.sql(f"DROP TABLE {name}")
    elif old:
        spark.sql(f"DROP VIEW {name}")
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def _behind(spark: SparkSession, name: str) -> tuple[str | None, bool]:
    """The table behind a view of ``replace_table``, and whether the name is a table itself."""
    if not spark.catalog.tableExists(name):
        return None, False
    if spark.catalog.getTable(name).tableType != "VIEW":
        return None, True
    properties = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return properties.get(BEHIND), False


def first_rows(result: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows, to be shown."""
    return result.limit(n)


def written(table: DataFrame) -> DataFrame:
    """``table`` written to the shared work folder and read back.

    Its size is then known before a join with it is planned, so a small one is broadcast and a large
    one is not; of a computed table Spark only learns the size after it has shuffled the other side.
    Several branches may read it, each only its own columns. The files survive the loss of executors
    and go when the application ends.
    """
    folder = work_folder(table.sparkSession, "written")
    table.write.parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)
