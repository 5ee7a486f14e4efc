"""The queries' entry from SQL text: a current database, a table by name, bounds as parameters, and functions for SQL.

Nothing a caller gives becomes part of the text: names go through ``IDENTIFIER``, values through named parameters.
"""

from pyspark.sql import DataFrame, SparkSession

# A blank bound (nothing left without characters up to U+0020) is no bound; both are constants, so the rest reaches the scan.
ACTIONS_BETWEEN = r"""
SELECT * FROM IDENTIFIER(:name)
WHERE (NOT coalesce(:start RLIKE '[^\\x00-\\x20]', false) OR date >= :start)
  AND (NOT coalesce(:end RLIKE '[^\\x00-\\x20]', false) OR date <= :end)"""

# The functions that SQL text can use, for one session; their results are those of ``functions`` and ``operators``.
FUNCTIONS = [
    r"""CREATE OR REPLACE TEMPORARY FUNCTION is_filled(text STRING) RETURNS BOOLEAN
    RETURN coalesce(text RLIKE '[^\\x00-\\x20]', false)""",
    r"""CREATE OR REPLACE TEMPORARY FUNCTION list_parts(text STRING) RETURNS ARRAY<STRING>
    RETURN CASE WHEN NOT endswith(text, ',') THEN split(text, ',')
      WHEN regexp_replace(text, ',+\\z', '') = '' THEN CAST(array() AS ARRAY<STRING>)
      ELSE split(regexp_replace(text, ',+\\z', ''), ',') END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION bucket_of(ts TIMESTAMP, seconds BIGINT) RETURNS TIMESTAMP
    RETURN timestamp_seconds(floor(unix_seconds(ts) / seconds) * seconds)""",
    """CREATE OR REPLACE TEMPORARY FUNCTION touched_categories(click BIGINT, orders STRING, pays STRING)
    RETURNS ARRAY<STRUCT<kind: STRING, category_id: STRING>>
    RETURN CASE WHEN click <> -1 THEN array(named_struct('kind', 'click', 'category_id', CAST(click AS STRING)))
      WHEN is_filled(orders) THEN transform(list_parts(orders), c -> named_struct('kind', 'order', 'category_id', c))
      WHEN is_filled(pays) THEN transform(list_parts(pays), c -> named_struct('kind', 'pay', 'category_id', c)) END""",
]

# The list is made per row and exploded in place. A SQL table function of a row's values would be planned as a join of the
# actions with their own distinct values.
CATEGORY_EVENTS = """
SELECT a.event_id, t.e.kind, t.e.category_id
FROM (SELECT event_id, touched_categories(click_category_id, order_category_ids, pay_category_ids) AS touched
      FROM IDENTIFIER(:name)) AS a, LATERAL explode(a.touched) AS t(e)"""


def use_database(spark: SparkSession, database: str) -> None:
    """Make ``database`` the session's current one."""
    spark.sql("USE IDENTIFIER(:database)", args={"database": database})


def actions_between(spark: SparkSession, name: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The actions of a table or view from ``start`` to ``end``, both inclusive; a null or blank bound is no bound."""
    return spark.sql(ACTIONS_BETWEEN, args={"name": name, "start": start, "end": end})


def create_functions(spark: SparkSession) -> None:
    """Define ``FUNCTIONS`` for the session: plain SQL that is expanded into the plan, no Python."""
    for text in FUNCTIONS:
        spark.sql(text)


def category_events(spark: SparkSession, name: str) -> DataFrame:
    """``operators.categories.category_events`` of a table or view, by ``touched_categories``."""
    create_functions(spark)
    return spark.sql(CATEGORY_EVENTS, args={"name": name})
