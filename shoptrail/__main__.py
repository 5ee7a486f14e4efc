"""Run one query from the command line: ``python -m shoptrail <query> ...`` or with spark-submit."""

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shoptrail.operators.categories import new_task_id
from shoptrail.plans import shop
from shoptrail.schemas import USER_VISIT_ACTION
from shoptrail.session import build_session
from shoptrail.sinks.jdbc import append_jdbc
from shoptrail.sources.clicks import file_click_lines, kafka_click_lines, parse_click_lines, sorted_out
from shoptrail.sources.tables import parquet_scan, table_scan
from shoptrail.streaming import jobs

SHOP = ["category_top10", "category_session_top10", "page_flow_ratio", "page_avg_dwell_ms"]
LIVE = {
    "blacklist": jobs.block_heavy_clickers,
    "user_ad_counts": jobs.count_user_ads,
    "ad_city_counts": jobs.count_city_ads,
    "ad_area_top3": jobs.rank_area_ads,
    "ad_trend": jobs.chart_trend,
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shoptrail", description=__doc__)
    queries = parser.add_subparsers(dest="query", required=True)
    for name in SHOP:
        query = queries.add_parser(name)
        source = query.add_mutually_exclusive_group(required=True)
        source.add_argument("--table", help="catalog table of visit actions, database.table")
        source.add_argument("--path", help="parquet folder of visit actions")
        query.add_argument("--start", help="first day, yyyy-MM-dd")
        query.add_argument("--end", help="last day, yyyy-MM-dd")
        query.add_argument("--ties", nargs="+", default=["page_id"], help="order of actions of the same second")
        if name == "page_flow_ratio":
            query.add_argument("--path-pages", default="1,2,3,4,5,6,7", help="target path")
        query.add_argument("--rows", type=int, help="print so many rows only; all by default")
        query.add_argument("--jdbc-url", help="append the result there instead of printing it")
        query.add_argument("--jdbc-table")
        query.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    for name in LIVE:
        query = queries.add_parser(name)
        source = query.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka bootstrap servers")
        source.add_argument("--lines", help="folder where files of click lines appear")
        query.add_argument("--topic", default="ads_log")
        query.add_argument("--root", required=True, help="folder of the tables the job keeps")
        query.add_argument("--checkpoint", required=True)
        query.add_argument("--once", action="store_true", help="stop when all there is has been read")
        query.add_argument("--starting", default="latest", help="Kafka offsets a new checkpoint starts at")
        query.add_argument("--batch-limit", type=int, help="Kafka offsets or files per batch; a backlog takes several")
        query.add_argument("--quarantine", help="folder for lines that cannot be read; without it such a line stops the job")
        if name == "blacklist":
            query.add_argument("--threshold", type=int, default=100)
            query.add_argument("--initial", help="parquet folder of users (user_id) banned from the start")
        if name in ("user_ad_counts", "ad_area_top3"):
            query.add_argument("--expire-after", help="drop days from the state so long after, for instance '7 days'")
        if name == "ad_trend":
            query.add_argument("--rows", type=int, help="print so many rows of a report only; all by default")
    return parser


def _shop_result(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    actions = table_scan(spark, args.table) if args.table else parquet_scan(spark, args.path)
    more = [c for c in args.ties if c not in USER_VISIT_ACTION.fieldNames()]
    if more:
        raise SystemExit(f"no columns of the visit actions: {more}")
    days = {"start": args.start, "end": args.end}
    if args.query == "page_flow_ratio":
        return shop.page_flow_ratio(actions, args.path_pages, ties=tuple(args.ties), **days)
    if args.query == "page_avg_dwell_ms":
        return shop.page_avg_dwell_ms(actions, ties=tuple(args.ties), **days)
    return getattr(shop, args.query)(actions, task_id=new_task_id(), **days)


def print_rows(result: DataFrame, rows: int | None = None) -> None:
    """Print a result, partition by partition; all of it unless ``rows`` is given."""
    print("|" + "|".join(result.columns) + "|")
    for row in (result if rows is None else result.limit(rows)).toLocalIterator():
        print("|" + "|".join("" if value is None else str(value) for value in row) + "|")


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"shoptrail-{args.query}")
    if args.query in SHOP:
        result = _shop_result(spark, args)
        if args.jdbc_url:
            options = dict(option.split("=", 1) for option in args.jdbc_option)
            append_jdbc(result, args.jdbc_url, args.jdbc_table or args.query, options)
        else:
            print_rows(result, args.rows)
        return
    if args.servers:
        lines = kafka_click_lines(spark, args.servers, args.topic, args.starting, args.batch_limit)
    else:
        lines = file_click_lines(spark, args.lines, args.batch_limit)
    options = {"trigger": jobs.ALL_AVAILABLE} if args.once else {}
    if args.query == "blacklist":
        options["threshold"] = args.threshold
        options["initial"] = spark.read.parquet(args.initial) if args.initial else None
    if getattr(args, "expire_after", None):
        options["expire_after"] = args.expire_after
    if args.query == "ad_trend":
        options["report"] = lambda windows: print_rows(windows, args.rows)
        if not args.once:
            options["ticks"] = jobs.live_ticks(spark)
    aside = None
    if args.quarantine:
        clicks, bad = sorted_out(lines)
        trigger = {"trigger": options["trigger"]} if args.once else {}
        aside = jobs.keep_bad_lines(bad, args.quarantine, f"{args.checkpoint}-quarantine", **trigger)
    else:
        clicks = parse_click_lines(lines)
    query = LIVE[args.query](clicks, args.root, args.checkpoint, **options)
    query.awaitTermination()
    if aside is not None:
        aside.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
