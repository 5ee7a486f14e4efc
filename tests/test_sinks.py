import subprocess
import sys
import tempfile
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shop_rows import actions, values
from shoptrail import schemas
from shoptrail.plans import shop
from shoptrail.sinks.jdbc import append_jdbc, jdbc_options
from shoptrail.sinks.tables import drop_table, first_rows, replace_table, written
from shoptrail.sources.clicks import kafka_click_lines
from shoptrail.sources.tables import parquet_scan, rows_table, table_scan, typed
from shoptrail.session import remove_work_folders, work_folder


def test_replace_table(spark, tmp_path):
    replace_table(spark.createDataFrame([(1, "x")], "a long, b string"), "replaced", str(tmp_path / "one"))
    table = replace_table(spark.createDataFrame([(2,), (3,)], "c long"), "replaced", str(tmp_path / "two"))
    assert table.columns == ["c"]
    assert values(spark.table("replaced")) == [(2,), (3,)]
    drop_table(spark, "replaced")
    drop_table(spark, "replaced")
    # A plain table is replaced as well.
    spark.createDataFrame([(1,)], "a long").write.saveAsTable("replaced")
    assert values(replace_table(spark.createDataFrame([(5,)], "a long"), "replaced")) == [(5,)]
    drop_table(spark, "replaced")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("replaced")]


def test_a_scan_reads_only_the_days_and_columns_of_the_query(spark, tmp_path):
    days = [f"2019-07-{d:02d}" for d in range(1, 11)]
    rows = actions(spark, *[{"date": d, "click_category_id": 1} for d in days]).drop("event_id")
    replace_table(rows, "visits", str(tmp_path / "visits"), partition_by=["date"])
    scan = table_scan(spark, "visits", "default")
    assert scan.schema.simpleString() == schemas.USER_VISIT_ACTION.simpleString()
    top = shop.category_top10(scan, "2019-07-03", "2019-07-05")
    assert values(top) == [("1", 3, 0, 0)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and ">= 2019-07-03" in plan and "<= 2019-07-05" in plan
    read = plan[plan.index("ReadSchema: ") :].splitlines()[0]
    assert read == "ReadSchema: struct<click_category_id:bigint,order_category_ids:string,pay_category_ids:string>"
    drop_table(spark, "visits")


def test_date_bounds_are_pushed_to_a_table_without_partitions(spark, tmp_path):
    path = str(tmp_path / "visits")
    actions(spark, {"date": "2019-07-01"}).write.parquet(path)
    plan = shop.category_top10(parquet_scan(spark, path), "2019-07-03", "2019-07-05")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2019-07-03)" in text and "LessThanOrEqual(date,2019-07-05)" in text


def test_rows_table_and_typed(spark):
    table = rows_table(spark, [(1, "Oslo", "east"), (2, "Bergen", "west")], schemas.CITY_INFO)
    assert values(table) == [(1, "Oslo", "east"), (2, "Bergen", "west")]
    texts = table.select(*[F.col(c).cast("string").alias(c) for c in table.columns], F.lit("x").alias("more"))
    assert typed(texts, schemas.CITY_INFO).schema == table.schema
    assert typed(texts, schemas.CITY_INFO, keep=["more"]).columns[-1] == "more"


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "category_top10", {"driver": "d", "user": "u"}, batch_size=500) == {
        "url": "jdbc:x",
        "dbtable": "category_top10",
        "batchsize": "500",
        "numPartitions": "8",
        "driver": "d",
        "user": "u",
    }


def test_jdbc_append_reaches_the_writer(spark):
    # No database may be started here, so this ends at the search for a driver.
    with pytest.raises(Exception, match="No suitable driver"):
        append_jdbc(spark.createDataFrame([(1,)], "a long"), "jdbc:none:here", "t")


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_click_lines(spark, "broker:9092")


def test_written_is_computed_once_and_read_by_column(spark):
    table = written(spark.range(5).withColumn("r", F.rand()))
    assert values(table) == values(table)
    assert "ReadSchema: struct<id:bigint>" in table.select("id")._jdf.queryExecution().executedPlan().toString()


def test_a_failed_replacement_leaves_the_old_table(spark):
    replace_table(spark.createDataFrame([(1,), (2,)], "a long"), "kept")
    bad = spark.table("kept").select(F.raise_error(F.lit("no")).cast("long").alias("a"))
    with pytest.raises(Exception, match="no"):
        replace_table(bad, "kept")
    assert values(spark.table("kept")) == [(1,), (2,)]
    kept = lambda: [t.name.split("__")[0] for t in spark.catalog.listTables() if t.name.startswith("kept")]
    assert kept() == ["kept", "kept"]  # the view and its table
    # A result may read from the table it replaces.
    assert values(replace_table(spark.table("kept").filter("a > 1"), "kept")) == [(2,)]
    assert kept() == ["kept", "kept"]
    drop_table(spark, "kept")
    assert kept() == []


def test_first_rows(spark):
    assert values(first_rows(spark.range(100).orderBy("id"), 2)) == [(0,), (1,)]


def test_work_folder_lies_in_the_shared_checkpoint_folder(spark):
    folder = work_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != work_folder(spark, "x")


class FakeSession:
    """A session without ``spark.checkpoint.dir``."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})


def test_a_cluster_needs_a_shared_folder(spark):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(FakeSession("spark://host:7077"), "x")
    local = FakeSession("local[2]")
    local.sparkContext, local._jvm = spark.sparkContext, spark._jvm
    assert work_folder(local, "x").startswith(tempfile.gettempdir())


def test_work_folders_go(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    table = written(spark.range(3))
    assert table.count() == 3 and any(shared.glob("shoptrail*"))
    remove_work_folders(spark)
    assert not any(shared.glob("shoptrail*"))
    assert written(spark.range(3)).count() == 3


def test_work_folders_go_when_the_process_ends(tmp_path):
    code = f"""
from shoptrail.session import build_session
from shoptrail.sinks.tables import written
spark = build_session("own", "local[1]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": "{tmp_path}"}})
assert written(spark.range(3)).count() == 3
import glob
assert glob.glob("{tmp_path}/shoptrail*")
spark.stop()
"""
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=300)
    for _ in range(60):  # the JVM ends a little after the process
        if not any(tmp_path.glob("shoptrail*")):
            break
        time.sleep(0.5)
    assert not any(tmp_path.glob("shoptrail*"))
