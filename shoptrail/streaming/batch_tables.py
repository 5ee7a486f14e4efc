"""Tables that streaming jobs keep in ``foreachBatch``: plain Parquet, one partition per day and batch.

Writing a batch overwrites its own partitions, so a replay changes nothing. Reading merges the rows of a key: counts are
summed, sets united, or the newest batch wins. Every ``compact_every`` batches the days that got rows since are merged into
a partition of their own; it counts for all batches up to its number, so what it was made of is no longer read, and goes at
the next compaction. Days without new rows are left alone. One job writes a table, its batches one after the other.
"""

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptrail.session import delete_folder

PARTS = ["day", "merged", "batch"]
NO_DAY = "all"


def summed(keys: Sequence[str], value: str = "n") -> Callable[[DataFrame], DataFrame]:
    """Merge by adding up ``value``."""
    return lambda rows: rows.groupBy(*keys).agg(F.sum(value).alias(value))


def united(rows: DataFrame) -> DataFrame:
    """Merge as a set."""
    return rows.drop("batch").distinct()


def newest(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge by keeping the row of the highest batch for each key; a batch has a key once."""

    def merge(rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*keys).agg(*(F.max_by(v, "batch").alias(v) for v in values))

    return merge


@dataclass(frozen=True)
class BatchTable:
    """Rows of ``schema`` under ``root``, merged by ``merge``; ``day`` names the column that splits them."""

    root: str
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame]
    day: str | None = "date"
    compact_every: int = 100

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write what ``batch_id`` adds, in place of an earlier try."""
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(rows.sparkSession, batch_id)
        self._write(rows, 0, batch_id)

    def read(self, spark: SparkSession, until: int | None = None, days: Sequence[str] | None = None) -> DataFrame:
        """The merged table, after batch ``until`` if that is given (one since the last compaction), of all or some days."""
        live = [p for p in self._live(spark, until) if days is None or p[0] in days]
        return self.merge(self._load(spark, live)).select(*self.schema.fieldNames())

    def compact(self, spark: SparkSession, before: int) -> None:
        """Merge each day's partitions of batches below ``before``, if it has several; an ordinary batch job.

        What earlier compactions replaced is deleted first, so that readers keep what they found for as long as it
        takes to the next one.
        """
        live = self._live(spark, before - 1)
        for day, merged, batch in self._partitions(spark):
            if batch < before and (day, merged, batch) not in live:
                delete_folder(spark, self._folder(day, merged, batch))
        count = defaultdict(int)
        for day, _, _ in live:
            count[day] += 1
        several = [p for p in live if count[p[0]] > 1]
        if several:
            self._write(self.merge(self._load(spark, several)), 1, before - 1)

    def _write(self, rows: DataFrame, merged: int, batch: int) -> None:
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        day = F.col(self.day) if self.day else F.lit(NO_DAY)
        parted = rows.withColumns({"day": day, "merged": F.lit(merged), "batch": F.lit(batch)})
        # Few files per partition: adaptive execution joins small ones and splits big ones.
        writer = parted.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PARTS).parquet(self.root)

    def _partitions(self, spark: SparkSession) -> set[tuple[str, int, int]]:
        """Day, whether it is merged, and batch of every partition; from the list of files, nothing is read."""
        files = spark.read.schema(self.schema).parquet(self.root).inputFiles()
        parts = (re.search(r"/day=([^/]+)/merged=(\d)/batch=(\d+)/", file) for file in files)
        return {(unquote(p[1]), int(p[2]), int(p[3])) for p in parts if p}

    def _live(self, spark: SparkSession, until: int | None) -> list[tuple[str, int, int]]:
        """What makes up the table: each day's newest merged partition, and the batches after it."""
        parts = [p for p in self._partitions(spark) if until is None or p[2] <= until]
        last = {day: batch for day, merged, batch in sorted(parts) if merged}
        return sorted(p for p in parts if p[2] > last.get(p[0], -1) or (p[1] and p[2] == last[p[0]]))

    def _load(self, spark: SparkSession, parts: Sequence[tuple[str, int, int]]) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        if not parts:
            return spark.createDataFrame([], stored)
        folders = [self._folder(*p) for p in parts]
        return spark.read.option("basePath", self.root).schema(stored).parquet(*folders).select(*stored.fieldNames())

    def _folder(self, day: str, merged: int, batch: int) -> str:
        return f"{self.root}/day={day}/merged={merged}/batch={batch}"
