"""Visit actions and ad clicks derived from an event log.

The event log holds ``event_id, ts, user_id, event_type, props``; the number ``k`` in ``props``
stands for the page, category or ad. These views feed the queries where no shop log is at hand.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cities broadcast at most; some 100 bytes each.
MOST_CITIES = 100_000

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k"
_DAY = "CAST(CAST(ts AS DATE) AS STRING) AS date"


def visit_actions(events: DataFrame) -> DataFrame:
    """``user_visit_action`` rows, one per event, with ``event_id`` as the tie-break of equal times."""
    return events.selectExpr("event_id", "user_id", "event_type", "ts", _K, _DAY).selectExpr(
        "date",
        "user_id",
        "concat('s', CAST(user_id AS STRING), '-', date) AS session_id",
        "CAST(k % 10 + 1 AS BIGINT) AS page_id",
        "substr(CAST(ts AS STRING), 1, 19) AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 6 AS STRING)) END AS search_keyword",
        "CAST(CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS BIGINT) AS click_category_id",
        "CAST(CASE WHEN event_type = 'click' THEN event_id % 100 + 1 ELSE -1 END AS BIGINT) AS click_product_id",
        """CASE WHEN event_type = 'signup' OR (event_type = 'purchase' AND k % 10 = 0)
           THEN concat_ws(',', k % 20 + 1, (k * 3) % 20 + 1, (k * 7) % 20 + 1) END AS order_category_ids""",
        "CAST(NULL AS STRING) AS order_product_ids",
        """CASE WHEN event_type = 'purchase'
           THEN concat_ws(',', (k + 5) % 20 + 1, (k * 3 + 5) % 20 + 1) END AS pay_category_ids""",
        "CAST(NULL AS STRING) AS pay_product_ids",
        "CAST(user_id % 25 AS BIGINT) AS city_id",
        "event_id",
    )


def ad_clicks(events: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Parsed ad clicks, one per event; a nation is a city, a region an area.

    The line format is separated by spaces, so an area name holds none. ``arrival`` trails the
    click by ``k`` seconds. Cities are counted and broadcast, so that clicks are neither broadcast nor
    shuffled on the few cities; more than ``MOST_CITIES`` are refused.
    """
    cities = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS city_key", "n_name AS city", "replace(r_name, ' ', '-') AS area"
    )
    if cities.limit(MOST_CITIES + 1).count() > MOST_CITIES:
        raise ValueError(f"more than {MOST_CITIES} cities to broadcast")
    keyed = events.selectExpr(
        "event_id", "user_id", "CAST(ts AS TIMESTAMP) AS ts", _DAY, _K, "user_id % 25 AS city_key"
    )
    return keyed.join(F.broadcast(cities), "city_key").selectExpr(
        "ts",
        "date",
        "area",
        "city",
        "CAST(user_id AS STRING) AS user_id",
        "CAST(k % 6 + 1 AS STRING) AS ad_id",
        "ts + make_dt_interval(0, 0, 0, k) AS arrival",
        "event_id",
    )


def click_lines(clicks: DataFrame) -> DataFrame:
    """The clicks as lines of the click log, ``(value, arrival)``."""
    return clicks.selectExpr("concat_ws(' ', unix_millis(ts), area, city, user_id, ad_id) AS value", "arrival")
