"""Small ``user_visit_action`` tables from the columns a test cares about."""

from pyspark.sql import types as T

from shoptrail.schemas import USER_VISIT_ACTION

SCHEMA = T.StructType([*USER_VISIT_ACTION.fields, T.StructField("event_id", T.LongType())])


def actions(spark, *rows):
    """Rows as dicts; ``event_id`` counts up where it is not given."""
    filled = []
    for i, row in enumerate(rows):
        values = {"date": "2019-07-01", "session_id": "s", "page_id": 1, "action_time": "2019-07-01 00:00:00",
                  "click_category_id": -1, "event_id": i, **row}
        filled.append(tuple(values.get(name) for name in SCHEMA.fieldNames()))
    return spark.createDataFrame(filled, SCHEMA)


def at(seconds):
    return f"2019-07-01 {seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


def visit(session, *pages, step=1, start=0):
    """A session that opens ``pages`` one after another."""
    return [
        {"session_id": session, "page_id": page, "action_time": at(start + i * step)} for i, page in enumerate(pages)
    ]


def values(result):
    return sorted((tuple(row) for row in result.collect()), key=repr)
