import os
import time

import pytest
from pyspark.sql import functions as F

from shop_rows import values
from shoptrail.operators import ads
from shoptrail.plans import ads as plans
from shoptrail.schemas import CITY_AD_COUNTS
from shoptrail.sources.clicks import file_click_lines, parse_click_lines, sorted_out
from shoptrail.streaming import jobs
from shoptrail.streaming.batch_tables import BatchTable, newest, summed, united

START = 1_562_068_800_000


def sample_lines(n=240):
    """Clicks one second apart: 5 users, 3 ads, 2 areas, over the border of a day."""
    lines = []
    for i in range(n):
        ts = START + 43_200_000 - 60_000 + i * 1000
        lines.append(f"{ts} {'north' if i % 4 else 'south'} c{i % 3} u{i * i % 5} {i % 7 % 3 + 1}")
    return lines


def drop_files(folder, lines, files, first=0):
    """Write the lines as files that a stream takes in order."""
    folder.mkdir(exist_ok=True)
    size = -(-len(lines) // files)
    for i in range(files):
        path = folder / f"lines-{first + i:03d}.txt"
        path.write_text("".join(f"{line}\n" for line in lines[i * size : (i + 1) * size]))
        os.utime(path, (1_600_000_000 + first + i, 1_600_000_000 + first + i))


def stream(spark, folder):
    """One file per batch; clicks arrive at once, so arrival does not depend on the test's clock."""
    clicks = parse_click_lines(file_click_lines(spark, str(folder), files_per_batch=1).drop("arrival"))
    return clicks.withColumn("arrival", F.col("ts"))


def batch(spark, lines):
    parsed = parse_click_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    return parsed.withColumn("arrival", F.col("ts"))


def run(job, spark, folder, tmp_path, **options):
    query = job(
        stream(spark, folder), str(tmp_path / "tables"), str(tmp_path / "checkpoint"),
        trigger=jobs.ALL_AVAILABLE, **options,
    )
    query.awaitTermination()
    return query


def places(folder):
    return str(folder / "tables"), str(folder / "checkpoint")


@pytest.mark.parametrize("files", [1, 3, 7])
def test_stream_equals_batch(spark, tmp_path, files):
    lines = sample_lines()
    drop_files(tmp_path / "in", lines, files)
    clicks = batch(spark, lines)

    run(jobs.count_city_ads, spark, tmp_path / "in", tmp_path / "a")
    got = jobs.city_counter_table(str(tmp_path / "a" / "tables"))
    assert values(got.read(spark)) == values(plans.ad_city_counts(clicks))
    assert jobs.finished_batch(spark, str(tmp_path / "a" / "checkpoint")) == files - 1

    run(jobs.rank_area_ads, spark, tmp_path / "in", tmp_path / "b")
    top = jobs.area_top_table(str(tmp_path / "b" / "tables")).read(spark)
    assert values(top) == values(plans.ad_area_top(clicks))

    run(jobs.count_user_ads, spark, tmp_path / "in", tmp_path / "c")
    counts = jobs.user_ad_counts(spark, *places(tmp_path / "c"))
    assert values(counts) == values(ads.count_by(clicks, ads.USER_KEYS))
    assert not (tmp_path / "c" / "tables").exists()

    run(jobs.block_heavy_clickers, spark, tmp_path / "in", tmp_path / "d", threshold=25)
    banned = values(jobs.banned_table(str(tmp_path / "d" / "tables")).read(spark))
    assert banned == values(plans.blacklist(clicks, 25))
    assert 0 < len(banned) < 5
    counters = jobs.state_counts(spark, str(tmp_path / "d" / "checkpoint"), ads.USER_KEYS)
    assert values(counters) == values(ads.count_by(clicks, ads.USER_KEYS))
    assert os.listdir(tmp_path / "d" / "tables") == ["banned"]

    run(jobs.chart_trend, spark, tmp_path / "in", tmp_path / "e")
    panes = jobs.trend_table(str(tmp_path / "e" / "tables")).read(spark)
    assert values(ads.trend_windows(panes)) == values(ads.trend_windows(ads.trend_panes(clicks)))


def test_a_ban_acts_from_the_next_batch_on(spark, tmp_path):
    lines = [f"{START + i} n x u 1" for i in range(5)] + [f"{START + 10} n x u 2", f"{START + 11} n x v 2"]
    drop_files(tmp_path / "in", lines[:5], 1)
    drop_files(tmp_path / "in", lines[5:], 1, first=1)
    initial = spark.createDataFrame([("w",)], "user_id string")
    seen = []
    see = lambda counts, batch_id: seen.append((batch_id, values(counts.select("ad_id", "user_id", "n"))))
    run(jobs.block_heavy_clickers, spark, tmp_path / "in", tmp_path, threshold=3, initial=initial, admitted=see)
    assert values(jobs.banned_table(str(tmp_path / "tables")).read(spark)) == [("u",), ("w",)]
    assert seen == [(0, [("1", "u", 5)]), (1, [("2", "v", 1)])]
    # The counters go on during the ban.
    counts = jobs.state_counts(spark, str(tmp_path / "checkpoint"), ads.USER_KEYS)
    assert values(counts.select("ad_id", "user_id", "n")) == [("1", "u", 5), ("2", "u", 1), ("2", "v", 1)]


def test_users_banned_before_are_not_judged(spark, tmp_path):
    drop_files(tmp_path / "in", [f"{START + i} n x {u} 1" for i, u in enumerate("wwwv")], 1)
    initial = spark.createDataFrame([("w",)], "user_id string")
    seen = []
    see = lambda counts, batch_id: seen.extend(values(counts.select("user_id", "n")))
    run(jobs.block_heavy_clickers, spark, tmp_path / "in", tmp_path, threshold=3, initial=initial, admitted=see)
    assert seen == [("v", 1)]


def result(spark, job, folder):
    tables = {jobs.count_city_ads: jobs.city_counter_table, jobs.rank_area_ads: jobs.area_top_table, jobs.block_heavy_clickers: jobs.banned_table}
    return values(jobs.user_ad_counts(spark, *places(folder)) if job is jobs.count_user_ads else tables[job](places(folder)[0]).read(spark))


@pytest.mark.parametrize("job", [jobs.count_city_ads, jobs.rank_area_ads, jobs.count_user_ads, jobs.block_heavy_clickers])
def test_a_job_goes_on_from_its_checkpoint(spark, tmp_path, job):
    lines = sample_lines()
    options = {"threshold": 25} if job is jobs.block_heavy_clickers else {}
    drop_files(tmp_path / "in", lines[:100], 2)
    run(job, spark, tmp_path / "in", tmp_path, **options)
    drop_files(tmp_path / "in", lines[100:], 2, first=2)
    run(job, spark, tmp_path / "in", tmp_path, **options)
    drop_files(tmp_path / "whole", lines, 1)
    run(job, spark, tmp_path / "whole", tmp_path / "once", **options)
    assert result(spark, job, tmp_path) == result(spark, job, tmp_path / "once")


@pytest.mark.parametrize("job", [jobs.count_city_ads, jobs.rank_area_ads, jobs.count_user_ads, jobs.block_heavy_clickers])
def test_a_replayed_batch_changes_nothing(spark, tmp_path, job):
    """The last commit is lost, as in a crash between the sink and the commit: the batch runs again."""
    drop_files(tmp_path / "in", sample_lines(), 3)
    options = {"threshold": 25} if job is jobs.block_heavy_clickers else {}
    run(job, spark, tmp_path / "in", tmp_path, **options)
    before = result(spark, job, tmp_path)
    for name in ("2", ".2.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    assert jobs.finished_batch(spark, str(tmp_path / "checkpoint")) == 1
    query = run(job, spark, tmp_path / "in", tmp_path, **options)
    assert [p["batchId"] for p in query.recentProgress if p["numInputRows"]] == [2]
    assert result(spark, job, tmp_path) == before


def test_a_reader_beside_the_job_sees_whole_batches(spark, tmp_path):
    """A batch whose sink has written, but which is not finished, is not read."""
    drop_files(tmp_path / "in", sample_lines(), 3)
    run(jobs.count_city_ads, spark, tmp_path / "in", tmp_path)
    assert jobs.finished_batch(spark, str(tmp_path / "nowhere")) == -1
    table = jobs.city_counter_table(places(tmp_path)[0])
    (tmp_path / "checkpoint" / "commits" / "2").unlink()
    until = jobs.finished_batch(spark, places(tmp_path)[1])
    assert until == 1 and table.read(spark, until).agg(F.sum("n")).first()[0] == 160
    assert table.read(spark).agg(F.sum("n")).first()[0] == 240


def test_the_top_ads_follow_from_old_and_changed_ones(spark, tmp_path):
    """Ads outside the top come up batch by batch, ties go by ad, other days and areas stay."""
    batches = [["n 1", "n 1", "n 2", "n 3", "n 4", "s 9"], ["n 4", "n 5", "s 8"], ["n 5", "n 5", "n 4"], ["n 6"]]
    lines = [[f"{START + 10 * i + j} {x.split()[0]} c u {x.split()[1]}" for j, x in enumerate(b)] for i, b in enumerate(batches)]
    for i, own in enumerate(lines):
        drop_files(tmp_path / "in", own, 1, first=i)
        run(jobs.rank_area_ads, spark, tmp_path / "in", tmp_path)
        want = plans.ad_area_top(batch(spark, [line for b in lines[: i + 1] for line in b]))
        assert result(spark, jobs.rank_area_ads, tmp_path) == values(want)


def test_expired_days_leave_the_state(spark, tmp_path):
    day = 86_400_000
    base = START // day * day
    line = lambda d: f"{base + d * day + 1000} n x u 1"
    # The watermark of a batch is that of the batch before, so day 0 is closed in the last batch.
    for i, d in enumerate([0, 5, 5, 0]):
        drop_files(tmp_path / "in", [line(d)], 1, first=i)
    counts = []
    for name, options in (("kept", {}), ("expired", {"expire_after": "1 day"})):
        run(jobs.count_user_ads, spark, tmp_path / "in", tmp_path / name, **options)
        counts.append(values(jobs.user_ad_counts(spark, *places(tmp_path / name), **options).select("date", "n")))
    assert [n for _, n in counts[0]] == [2, 2]
    assert [n for _, n in counts[1]] == [1, 2]
    assert jobs.state_counts(spark, places(tmp_path / "expired")[1], ads.USER_KEYS).count() == 1


def reported(windows):
    return [(r.window_start.strftime("%H:%M:%S"), r.bucket[-8:], r.n) for r in windows.collect()]


def test_every_window_that_ended_is_reported_once(spark, tmp_path):
    seconds = [[1, 59], [61, 75], [130], [62]]
    for i, batch_seconds in enumerate(seconds):
        drop_files(tmp_path / "in", [f"{START + s * 1000} n x u 1" for s in batch_seconds], 1, first=i)
    reports = []
    run(jobs.chart_trend, spark, tmp_path / "in", tmp_path, report=lambda windows: reports.append(reported(windows)))
    # Windows that end at 12:00:10 to 12:01:00, then the two up to 12:01:20, then up to 12:02:20; the
    # late click ends no window.
    assert len(reports) == 3
    first = [("11:59:10", "12-00-00", 1), ("11:59:20", "12-00-00", 1), ("11:59:30", "12-00-00", 1)]
    assert reports[0] == [*first, ("11:59:40", "12-00-00", 1), ("11:59:50", "12-00-00", 1), ("12:00:00", "12-00-00", 1), ("12:00:00", "12-00-50", 1)]
    assert reports[1] == [("12:00:10", "12-00-50", 1), ("12:00:10", "12-01-00", 1),
                          ("12:00:20", "12-00-50", 1), ("12:00:20", "12-01-00", 1), ("12:00:20", "12-01-10", 1)]
    starts = [f"12:00:{s}" for s in (30, 40, 50)] + [f"12:01:{s:02d}" for s in (0, 10, 20)]
    assert sorted({r[0] for r in reports[2]}) == starts and reports[2][-1] == ("12:01:20", "12-02-10", 1)
    # All clicks count, also the late one.
    panes = jobs.trend_table(str(tmp_path / "tables")).read(spark)
    assert panes.agg(F.sum("n")).first()[0] == 6


def test_reports_go_on_after_a_restart(spark, tmp_path):
    reports = []
    for i, batch_seconds in enumerate([[5], [38]]):
        drop_files(tmp_path / "in", [f"{START + s * 1000} n x u 1" for s in batch_seconds], 1, first=i)
        run(jobs.chart_trend, spark, tmp_path / "in", tmp_path, width=10, report=lambda windows: reports.append(reported(windows)))
    assert reports == [[("12:00:00", "12-00-00", 1)], [("12:00:30", "12-00-30", 1)]]


def test_a_batch_ten_minutes_late_counts(spark, tmp_path):
    lines = [f"{START + s * 1000} n x u 1" for s in (700, 710, 20, 720, 730, 30)]
    drop_files(tmp_path / "in", lines, 6)
    run(jobs.chart_trend, spark, tmp_path / "in", tmp_path)
    panes = jobs.trend_table(str(tmp_path / "tables")).read(spark)
    assert values(ads.trend_windows(panes)) == values(ads.trend_windows(ads.trend_panes(batch(spark, lines))))


def test_a_job_runs_on_the_five_second_trigger(spark, tmp_path):
    drop_files(tmp_path / "in", sample_lines(30), 1)
    root = str(tmp_path / "tables")
    query = jobs.count_city_ads(stream(spark, tmp_path / "in"), root, str(tmp_path / "checkpoint"))
    try:
        drop_files(tmp_path / "in", sample_lines(60)[30:], 1, first=1)
        for _ in range(60):
            time.sleep(0.5)
            if sum(p["numInputRows"] for p in query.recentProgress) == 60:
                break
    finally:
        query.stop()
    assert jobs.city_counter_table(root).read(spark).agg(F.sum("n")).first()[0] == 60


ROWS = [[("2019-07-02", "n", "x", str(i % 3), i + 1), (f"2019-07-{3 + i % 2:02d}", "n", "x", "1", 1)] for i in range(11)]


@pytest.mark.parametrize("merge", [summed(ads.CITY_KEYS), newest(ads.CITY_KEYS), united], ids=["summed", "newest", "united"])
def test_compacted_tables_read_the_same(spark, tmp_path, merge):
    tables = [BatchTable(str(tmp_path / name), CITY_AD_COUNTS, merge, day, every)
              for name, day, every in (("a", "date", 3), ("b", None, 4), ("c", "date", 1000))]
    for batch_id, rows in enumerate(ROWS):
        frame = spark.createDataFrame(rows, CITY_AD_COUNTS).coalesce(1)
        for table in tables:
            table.put(frame, batch_id)
            if batch_id % 3 == 0:  # a replay, compaction included
                table.put(frame, batch_id)
        first, *others = [values(table.read(spark)) for table in tables]
        assert all(other == first for other in others), batch_id
    assert values(tables[0].read(spark, until=9)) == values(tables[2].read(spark, until=9))
    assert {r.date for r in tables[0].read(spark, days=["2019-07-03"]).collect()} == {"2019-07-03"}


def test_compaction_rewrites_only_days_with_new_rows_and_old_partitions_go(spark, tmp_path):
    table = BatchTable(str(tmp_path), CITY_AD_COUNTS, summed(ads.CITY_KEYS), compact_every=5)
    for batch_id in range(31):
        day = "2019-07-01" if batch_id < 7 else "2019-07-02"
        table.put(spark.createDataFrame([(day, "n", "x", "1", 1)], CITY_AD_COUNTS).coalesce(1), batch_id)
    assert values(table.read(spark)) == [("2019-07-01", "n", "x", "1", 7), ("2019-07-02", "n", "x", "1", 24)]
    merged = {day: sorted(p.name for p in (tmp_path / f"day={day}" / "merged=1").iterdir()) for day in ("2019-07-01", "2019-07-02")}
    assert merged["2019-07-01"] == ["batch=9"] and merged["2019-07-02"] == ["batch=24", "batch=29"]
    # Those of the last two rounds are left.
    left = sorted(p.name for p in (tmp_path / "day=2019-07-02" / "merged=0").iterdir())
    assert left == [f"batch={b}" for b in (25, 26, 27, 28, 29, 30)]


def test_a_reader_keeps_its_files_until_the_next_compaction(spark, tmp_path):
    table = BatchTable(str(tmp_path), CITY_AD_COUNTS, summed(ads.CITY_KEYS), compact_every=3)
    put = lambda b: table.put(spark.createDataFrame([("2019-07-01", "n", "x", "1", 1)], CITY_AD_COUNTS).coalesce(1), b)
    for batch_id in range(3):
        put(batch_id)
    early = table.read(spark)
    for batch_id in range(3, 6):
        put(batch_id)
    assert values(early) == [("2019-07-01", "n", "x", "1", 3)]


def test_an_empty_table_is_empty(spark, tmp_path):
    table = jobs.banned_table(str(tmp_path))
    table.put(spark.createDataFrame([], "user_id string"), 0)
    assert table.read(spark).count() == table.read(spark, until=0).count() == 0


def test_a_read_of_some_days_opens_no_others(spark, tmp_path):
    table = BatchTable(str(tmp_path), CITY_AD_COUNTS, summed(ads.CITY_KEYS))
    table.put(spark.createDataFrame([(f"2019-07-{d:02d}", "n", "x", "1", d) for d in range(1, 10)], CITY_AD_COUNTS), 0)
    some = table.read(spark, days=["2019-07-03"])
    assert values(some) == [("2019-07-03", "n", "x", "1", 3)]
    assert {file.split("/day=")[1][:10] for file in some.inputFiles()} == {"2019-07-03"}


def ticks(spark, folder, seconds):
    """A stream of times, one per batch."""
    drop_files(folder, [str(START // 1000 + s) for s in seconds], len(seconds))
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))
    return lines.select(F.timestamp_seconds(F.col("value").cast("bigint")).alias("arrival"))


def test_a_pause_of_three_slides_is_reported_three_times(spark, tmp_path):
    for i, own in enumerate([[1], [], [], [], [45]]):
        drop_files(tmp_path / "in", [f"{START + s * 1000} n x u 1" for s in own], 1, first=i)
    reports = []
    run(jobs.chart_trend, spark, tmp_path / "in", tmp_path, width=20, report=lambda w: reports.append(reported(w)),
        ticks=ticks(spark, tmp_path / "ticks", [0, 10, 20, 30, 40]))
    # By second 0 the first window that ends has no click yet; the click at second 1 is in the windows that end at 10 and 20.
    row = lambda s: ("11:59:50" if s == 10 else "12:00:00", "12-00-00", 1)
    assert reports == [[row(10)], [row(20)], [], []]
    assert jobs.trend_table(places(tmp_path)[0]).read(spark).agg(F.sum("n")).first()[0] == 2


def test_ticks_of_a_rate_source_report_silence(spark, tmp_path):
    drop_files(tmp_path / "in", [f"{START + 1000} n x u 1"], 1)
    rate = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=1, startTimestamp=START, advanceMillisPerBatch=10_000).load()
    reports = []
    query = jobs.chart_trend(
        stream(spark, tmp_path / "in"), *places(tmp_path), width=10, report=lambda w: reports.append(reported(w)),
        ticks=rate.select(F.col("timestamp").alias("arrival")), trigger={"processingTime": "0 seconds"},
    )
    try:
        for _ in range(120):
            time.sleep(0.5)
            if len(reports) >= 4:
                break
    finally:
        query.stop()
    assert reports[0] == [("12:00:00", "12-00-00", 1)] and reports[1:4] == [[], [], []]


def test_live_ticks_tell_the_time(spark, tmp_path):
    query = jobs.live_ticks(spark).writeStream.format("memory").queryName("ticks_seen").option("checkpointLocation", str(tmp_path)).start()
    try:
        for _ in range(60):
            time.sleep(0.5)
            if spark.table("ticks_seen").count() >= 2:
                break
    finally:
        query.stop()
    assert spark.table("ticks_seen").columns == ["arrival"] and spark.table("ticks_seen").count() >= 2


@pytest.mark.parametrize("delay", ["5 seconds", "1 day"])
def test_closed_late_and_open_windows_are_the_whole_trend(spark, tmp_path, delay):
    seconds = [[1, 30], [75, 80], [20, 130], [131, 5], [300], [31, 299], [301]]
    lines = [[f"{START + s * 1000} n x u 1" for s in own] for own in seconds]
    for i, own in enumerate(lines):
        drop_files(tmp_path / "in", own, 1, first=i)
        if i in (3, 6):  # a restart between
            run(jobs.chart_closed_windows, spark, tmp_path / "in", tmp_path, delay=delay)
    whole = ads.trend_windows(ads.trend_panes(batch(spark, sum(lines, []))))
    assert values(jobs.trend_so_far(spark, *places(tmp_path))) == values(whole)
    late = jobs.late_window_table(places(tmp_path)[0]).read(spark)
    closed = jobs.closed_window_table(places(tmp_path)[0]).read(spark)
    assert late.isEmpty() == closed.isEmpty() == (delay == "1 day")
    with pytest.raises(ValueError, match="gaps"):
        jobs.chart_closed_windows(stream(spark, tmp_path / "in"), *places(tmp_path), delay=delay, width=10, slide=20)


def test_bad_lines_are_set_aside_and_the_job_goes_on(spark, tmp_path):
    good = sample_lines(20)
    bad = ["", "noon n x u 1", f"{START} n x u", f"{10**17} n x u 1", f"{10**30} n x u 1"]
    drop_files(tmp_path / "in", good[:10] + bad[:3], 1)
    drop_files(tmp_path / "in", bad[3:] + good[10:], 1, first=1)
    clicks, aside = sorted_out(file_click_lines(spark, str(tmp_path / "in"), files_per_batch=1))
    jobs.count_city_ads(clicks, *places(tmp_path), trigger=jobs.ALL_AVAILABLE).awaitTermination()
    for _ in range(2):  # a restart keeps each line once
        jobs.keep_bad_lines(aside, str(tmp_path / "bad"), str(tmp_path / "bad-checkpoint"), jobs.ALL_AVAILABLE).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "bad"))
    assert values(kept.select("value")) == sorted((line,) for line in bad)
    assert {r.value: r.reason for r in kept.collect()}["noon n x u 1"] == "the time is no number"
    assert values(jobs.city_counter_table(places(tmp_path)[0]).read(spark)) == values(plans.ad_city_counts(batch(spark, good)))


def test_console(spark, tmp_path):
    drop_files(tmp_path / "in", sample_lines(20), 1)
    counts = jobs.running_counts(stream(spark, tmp_path / "in"), ["area"])
    query = jobs.to_console(counts, str(tmp_path / "checkpoint"), trigger=jobs.ALL_AVAILABLE)
    query.awaitTermination()
    assert "ConsoleTable" in query.lastProgress["sink"]["description"]
    assert query.exception() is None and query.recentProgress[0]["numInputRows"] == 20
