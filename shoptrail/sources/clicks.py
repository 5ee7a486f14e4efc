"""The ad-click log: one text line per click, ``epoch-ms area city user ad``."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.functions.times import day_text


def kafka_click_lines(
    spark: SparkSession, servers: str, topic: str = "ads_log", starting: str = "latest",
    offsets_per_batch: int | None = None, **options: str,
) -> DataFrame:
    """Click lines of a Kafka topic as ``(value, arrival)``; needs the Kafka connector package.

    ``arrival`` is the record's own timestamp. Offsets live in the query's checkpoint, so every job
    reads the whole topic by itself and no consumer group is shared. ``offsets_per_batch`` cuts a
    backlog into batches; nothing is skipped.
    """
    if offsets_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(offsets_per_batch)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    return line_values(reader.load().withColumnRenamed("timestamp", "arrival"))


def file_click_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Click lines of text files that appear in a folder, as ``(value, arrival)``.

    ``arrival`` is the time of the micro-batch, which a replay of the batch keeps.
    """
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return line_values(reader.load(path).withColumn("arrival", F.current_timestamp()))


def line_values(records: DataFrame) -> DataFrame:
    """The text value of each record, and its arrival time where there is one."""
    extra = [c for c in ("arrival",) if c in records.columns]
    return records.select(F.col("value").cast("string").alias("value"), *extra)


def parse_click_lines(lines: DataFrame) -> DataFrame:
    """``(ts, date, area, city, user_id, ad_id)`` of each line; ``arrival`` and the like are kept.

    A line with too few fields, or with a time that is no number, fails the query under ANSI mode.
    """
    fields = F.split("value", " ")
    ts = F.timestamp_millis(fields.getItem(0).cast("bigint"))
    return lines.select(
        ts.alias("ts"),
        day_text(ts).alias("date"),
        fields.getItem(1).alias("area"),
        fields.getItem(2).alias("city"),
        fields.getItem(3).alias("user_id"),
        fields.getItem(4).alias("ad_id"),
        *[c for c in lines.columns if c != "value"],
    )


# Times from year 1 to 9999, in epoch milliseconds.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def line_fault(value: Column) -> Column:
    """Why a click line cannot be read; null for a good one."""
    fields = F.split(value, " ")
    ms = F.get(fields, F.lit(0)).try_cast("bigint")
    return (
        F.when(value.isNull(), "no line")
        .when(F.size(fields) < 5, "too few fields")
        .when(ms.isNull(), "the time is no number")
        .when(~ms.between(FIRST_MS, LAST_MS), "the time is out of range")
    )


def sorted_out(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The clicks of the good lines, as ``parse_click_lines`` gives them, and the bad lines with the ``reason``.

    For jobs that have to go on where a line is bad; each line is in one of the two.
    """
    fault = line_fault(F.col("value"))
    return parse_click_lines(lines.filter(fault.isNull())), lines.withColumn("reason", fault).filter("reason IS NOT NULL")
