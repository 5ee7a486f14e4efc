import re

import pytest

from shoptrail.llm import queries, url_filter

SF_DIR = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.DOTALL).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def fitting(host, path, rules):
    found = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found)[1:] if found else (None, None)


URLS = [
    "http://EXAMPLE.net/en/1?x=/de/", "https://a.b.example.net/EN/1", "http://notexample.net/en/", "ftp://net/", "http://net", "http://x.net?/y",
    "http://example.com/de/#a", "http://www.example.com/de", "http://de.org/fr/x", "http://org/fr/", "no scheme", "", None, "://", "a://b://c/d",
    "http://example.net:80/en/", "http://exÄmple.org/fr/\nline", "http://" + "a" * 5000 + ".net/" + "b" * 20000,
]


def test_parts_and_rules_equal_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id int, url string")
    for r in url_filter.judged(pages, queries.URL_RULES, url_filter.ALLOW).collect():
        host, path = parts(URLS[r["page_id"]])
        rule, verdict = fitting(host, path, queries.URL_RULES)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or url_filter.ALLOW)


def test_grams_equal_brute_force(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("ab.c", "/x/"), ("", "")], "host string, path string")
    found = [sorted(r[0]) for r in rows.select(url_filter.grams(F.col("host"), F.col("path"))).collect()]
    runs = lambda text, mark: [mark + f"^{text}$"[i : i + n] for n in url_filter.LENGTHS for i in range(len(text) + 3 - n)]
    assert found == [sorted(runs("ab.c", "h") + runs("/x/", "p")), sorted(runs("", "h") + runs("", "p"))]


def test_held_out_accuracy(spark):
    """Hosts decide some verdicts and paths others; half of the URLs are held out."""
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        host = f"{'casino' if i % 6 == 0 else 'news'}{i}.example.{'com' if i % 2 else 'org'}"
        rows.append((i, f"http://{host}/{'win-money' if bad else 'article'}/{i}", "block" if bad else "allow"))
    table = spark.createDataFrame(rows, "page_id int, url string, verdict string")
    model = url_filter.fit(table.filter("page_id % 4 < 2").select("url", "verdict"))
    judged = url_filter.judged(table.filter("page_id % 4 >= 2"), [], model).join(table.withColumnRenamed("verdict", "label"), "page_id")
    assert judged.count() == 300 and judged.filter("verdict = label").count() >= 295


def test_whole_table_and_plan(spark):
    result = queries.op6_url_ngrams(spark, SF_DIR)
    assert not re.search("Python|Pandas|Arrow", result._jdf.queryExecution().executedPlan().toString())
    rows = result.collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()}
    assert {r["page_id"] for r in rows} == set(urls)
    for r in rows:
        assert (r["host"], r["path"]) == parts(urls[r["page_id"]])
        rule, verdict = fitting(r["host"], r["path"], queries.URL_RULES)
        assert r["rule"] == rule and r["verdict"] == (verdict or ("block" if r["p_block"] >= 0.5 else "allow"))
    # Where a rule decides, the model agrees with it nearly always.
    ruled = [r for r in rows if r["rule"]]
    assert sum((r["p_block"] >= 0.5) == (r["verdict"] == "block") for r in ruled) >= 0.98 * len(ruled)


def test_odd_tables(spark):
    pages = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, "http://a.b/c", "y")], "page_id int, url string, verdict string")
    assert url_filter.fit(pages.limit(0)) == url_filter.ALLOW
    assert url_filter.fit(pages.selectExpr("url", "'block' AS verdict")) == url_filter.BLOCK
    assert url_filter.judged(pages, queries.URL_RULES, url_filter.BLOCK).filter("verdict = 'block'").count() == 3
    assert url_filter.judged(pages.limit(0), queries.URL_RULES, url_filter.BLOCK).collect() == []
    both = spark.createDataFrame([("http://a.b/c", "block"), ("http://a.b/c", "allow"), ("http://x.y/z", "allow"), ("http://q", "odd")], "url string, verdict string")
    assert not isinstance(url_filter.fit(both), str)
    with pytest.raises(ValueError):
        url_filter.judged(pages, [("a", "/", "block")] * 1001, url_filter.BLOCK)
