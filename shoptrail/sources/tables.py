"""Batch inputs: catalog tables, parquet folders and rows given by the caller."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shoptrail.schemas import USER_VISIT_ACTION


def typed(table: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Select the columns of ``schema``, cast to its types, and those named in ``keep``."""
    wanted = [f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]
    return table.selectExpr(*wanted, *[f"`{name}`" for name in keep])


def table_scan(
    spark: SparkSession,
    name: str,
    database: str | None = None,
    schema: T.StructType = USER_VISIT_ACTION,
    keep: Iterable[str] = (),
) -> DataFrame:
    """A catalog table under its fixed schema, with the further columns named in ``keep``.

    Nothing is read here: the columns and date bounds a query uses reach the scan.
    """
    return typed(spark.table(f"{database}.{name}" if database else name), schema, keep)


def parquet_scan(spark: SparkSession, path: str, schema: T.StructType = USER_VISIT_ACTION) -> DataFrame:
    """The same for a parquet folder outside the catalog."""
    return typed(spark.read.parquet(path), schema)


def rows_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A table of rows the caller holds, for small dimensions."""
    return spark.createDataFrame(list(rows), schema)
