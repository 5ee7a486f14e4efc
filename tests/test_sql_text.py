import pytest
from pyspark.sql import functions as F

from shop_rows import actions, values
from shoptrail.functions import documents
from shoptrail.functions.text import is_not_blank, split_list
from shoptrail.functions.times import bucket_start
from shoptrail.operators import sessions
from shoptrail.sources import session_tables, sql_text


@pytest.fixture
def visits(spark):
    days = [f"2019-07-{d:02d}" for d in range(1, 11)]
    actions(spark, *[{"date": d} for d in days], {"date": "x' OR '1'='1"}).createOrReplaceTempView("visits_view")
    return "visits_view"


def test_bounds_are_parameters(spark, visits):
    days = lambda *bounds: [r.date for r in sql_text.actions_between(spark, visits, *bounds).orderBy("date").collect()]
    assert len(days()) == len(days("", " \t\n\x00")) == 11
    assert days("2019-07-03", "2019-07-04") == ["2019-07-03", "2019-07-04"]
    assert days("2019-07-09", None)[:2] == ["2019-07-09", "2019-07-10"]
    # A quote in a bound is data.
    assert days("x' OR '1'='1", None) == ["x' OR '1'='1"] and days("y' OR 'a'='a", None) == []


def test_bounds_reach_the_scan(spark, tmp_path):
    actions(spark, {"date": "2019-07-01"}).write.parquet(str(tmp_path / "v"))
    spark.read.parquet(str(tmp_path / "v")).createOrReplaceTempView("visits_on_disk")
    plan = sql_text.actions_between(spark, "visits_on_disk", "2019-07-03", " ")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2019-07-03)" in plan and "LessThanOrEqual" not in plan and "RLIKE" not in plan


def test_a_name_is_no_text(spark, visits):
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR|TABLE_OR_VIEW_NOT_FOUND|IDENTIFIER"):
        sql_text.actions_between(spark, "visits_view; DROP VIEW visits_view").count()
    sql_text.use_database(spark, "default")
    with pytest.raises(Exception, match="SCHEMA_NOT_FOUND|PARSE|IDENTIFIER|CATALOG"):
        sql_text.use_database(spark, "no such; place")
    assert sql_text.actions_between(spark, visits).count() == 11


def test_sql_functions_equal_the_column_functions(spark):
    sql_text.create_functions(spark)
    texts = [None, "", " ", "\t", ",", "1", "1,2", "1,2,,", ",1", "1,,2", "\x00\x1f", ",,", "a b,"]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    both = table.selectExpr("t", "is_filled(t) AS filled", "list_parts(t) AS parts").select(
        "*", F.coalesce(is_not_blank(F.col("t")), F.lit(False)).alias("filled_2"), split_list(F.col("t")).alias("parts_2")
    )
    assert all(r.filled == r.filled_2 and r.parts == r.parts_2 for r in both.collect())
    times = spark.sql("SELECT TIMESTAMP '2019-07-02 12:00:57.9' AS ts").selectExpr("ts", "bucket_of(ts, 10) AS b")
    assert times.filter(F.col("b") == bucket_start(F.col("ts"), 10)).count() == 1


def test_documents(spark):
    texts = ['{"a": {"b": [1, 2.5, "x"]}, "d": "2024-01-02"}', '{"a": null}', "[1]", None]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("v", documents.document(F.col("t")))
    field = documents.typed_field
    got = table.select(
        field(F.col("v"), "$.a.b[0]", "int"), field(F.col("v"), "$.d", "date").cast("string"), field(F.col("v"), "$.a.b[2]", "int", strict=False),
        documents.document_text(F.col("v")),
    )
    assert [tuple(r) for r in got.collect()] == [
        (1, "2024-01-02", None, '{"a":{"b":[1,2.5,"x"]},"d":"2024-01-02"}'), (None, None, None, '{"a":null}'), (None, None, None, "[1]"), (None, None, None, None),
    ]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        table.select(field(F.col("v"), "$.a.b[2]", "int")).collect()
    bad = spark.createDataFrame([("{",)], "t string")
    assert bad.select(documents.document(F.col("t"), strict=False).isNull()).first()[0]
    with pytest.raises(Exception, match="MALFORMED_RECORD|PARS"):
        bad.select(documents.document_text(documents.document(F.col("t")))).collect()


@pytest.mark.parametrize("hot_rows", [sessions.HOT_ROWS, 3])
def test_stored_sessions_are_followed_as_others(spark, tmp_path, hot_rows):
    rows = [{"session_id": s, "page_id": i % 4, "action_time": f"2019-07-01 00:00:{i % 3:02d}"} for s in ("a", "b", None, "") for i in range(5)]
    rows += [{"session_id": f"s{i}", "page_id": i} for i in range(30)]
    table = actions(spark, *rows)
    session_tables.store_sessions(table, "stored_visits", str(tmp_path), 3, hot_rows=hot_rows, slots=16)
    assert (spark.table("stored_visits_hot").count() > 0) == (hot_rows == 3)
    got = session_tables.next_actions(spark, "stored_visits", ["page_id"])
    columns = ["session_id", "event_id", "next_page_id", "has_next"]
    want = sessions.with_next_action(table.select("session_id", "action_time", "event_id", "page_id"), ["page_id"])
    assert values(got.select(columns)) == values(want.select(columns))
    # Stored again, it is replaced.
    session_tables.store_sessions(table.limit(3), "stored_visits", str(tmp_path / "again"), 2)
    assert session_tables.next_actions(spark, "stored_visits", ["page_id"]).count() == 3
    for name in ("stored_visits", "stored_visits_hot"):
        spark.sql(f"DROP TABLE {name}")
