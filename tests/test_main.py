import pytest

from shop_rows import actions, values, visit
from shoptrail.__main__ import LIVE, SHOP, main
from shoptrail.streaming import jobs
from test_streaming import drop_files, sample_lines


@pytest.mark.parametrize("query", SHOP)
def test_shop_queries_print_their_result(spark, tmp_path, capsys, query):
    path = str(tmp_path / "visits")
    rows = visit("a", 1, 2, 3)
    rows[0]["click_category_id"] = 8
    actions(spark, *rows).drop("event_id").write.parquet(path)
    main([query, "--path", path, "--start", "2019-07-01", "--end", "2019-07-31"])
    printed = capsys.readouterr().out
    expected = {"category_top10": "|8|", "category_session_top10": "|8|", "page_flow_ratio": "|2|",
                "page_avg_dwell_ms": "|1000"}
    assert expected[query] in printed


def test_all_rows_are_printed(spark, tmp_path, capsys):
    path = str(tmp_path / "visits")
    actions(spark, *visit("a", *range(1, 152))).drop("event_id").write.parquet(path)
    main(["page_avg_dwell_ms", "--path", path])
    assert len(capsys.readouterr().out.strip().splitlines()) == 1 + 150
    main(["page_avg_dwell_ms", "--path", path, "--rows", "7"])
    assert len(capsys.readouterr().out.strip().splitlines()) == 1 + 7


def test_a_backlog_is_cut_into_batches(spark, tmp_path, capsys):
    drop_files(tmp_path / "in", sample_lines(60), 3)
    root = str(tmp_path / "tables")
    main(["ad_city_counts", "--lines", str(tmp_path / "in"), "--root", root, "--checkpoint", str(tmp_path / "cp"), "--once",
          "--batch-limit", "1"])
    assert jobs.city_counter_table(root).read(spark, until=2).agg({"n": "sum"}).first()[0] == 60


@pytest.mark.parametrize("query", list(LIVE))
def test_live_queries_run_to_the_end_of_the_input(spark, tmp_path, query):
    drop_files(tmp_path / "in", sample_lines(40), 1)
    root = str(tmp_path / "tables")
    more = ["--threshold", "4"] if query == "blacklist" else []
    main([query, "--lines", str(tmp_path / "in"), "--root", root, "--checkpoint", str(tmp_path / "cp"), "--once", *more])
    tables = [jobs.banned_table, None, jobs.city_counter_table, jobs.area_top_table, jobs.trend_table]
    table = dict(zip(LIVE, tables))[query]
    assert values(table(root).read(spark) if table else jobs.user_ad_counts(spark, root, str(tmp_path / "cp")))


def test_unknown_tie_columns_are_refused(spark, tmp_path):
    path = str(tmp_path / "visits")
    actions(spark, {}).write.parquet(path)
    with pytest.raises(SystemExit, match="event"):
        main(["page_avg_dwell_ms", "--path", path, "--ties", "event"])
