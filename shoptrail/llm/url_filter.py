"""URL filters: rules by host and path, and a logistic regression on hashed character n-grams for the rest.

DataFrame functions and Spark's own feature hashing and regression only.
"""

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import let, lower_ascii, written

ALLOW, BLOCK = "allow", "block"

# Rules stand in the plan as literals; a longer list is refused, not cut.
MOST_RULES = 1000

# Labelled URLs the regression is fitted on at most, the first by hash of the URL.
MAX_LABELLED = 20_000

LENGTHS, DIMENSIONS = (3, 4), 1 << 14


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#``
    or the end. Both empty for null and without ``://``."""
    rest = F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``rule`` and ``verdict`` of the longest rule (host, path, verdict) that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Of equally long ones the last by
    text counts; of equal ones with both verdicts, block.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")

    def candidate(rule: tuple[str, str, str]) -> Column:
        name, start, verdict = rule
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        text = name + start
        found = F.struct(F.lit(len(text)).alias("n"), F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        return F.when(fits, found)

    nothing = F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    return F.array_max(F.array(nothing, *map(candidate, rules)))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, marked by where they come from and bounded by ``^`` and ``$``."""

    def runs(text: Column, mark: str, n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))

    def all_runs(text: Column, mark: str) -> Column:
        bounded = F.concat(F.lit("^"), text, F.lit("$"))
        return let(bounded, lambda x: F.concat(*(runs(x, mark, n) for n in LENGTHS)))

    return F.concat(all_runs(host, "h"), all_runs(path, "p"))


def _hashed(rows: DataFrame) -> DataFrame:
    found = rows.withColumn("_grams", grams(F.col("host"), F.col("path")))
    return HashingTF(binary=True, numFeatures=DIMENSIONS, inputCol="_grams", outputCol="_features").transform(found).drop("_grams")


def fit(labelled: DataFrame):
    """A regression for ``block`` from the rows (``url``, ``verdict``); at most ``MAX_LABELLED`` distinct URLs are used.

    Null URLs and other verdicts are left out; a URL labelled both ways counts as block. With one verdict only there is
    nothing to learn and that verdict (without any, allow) is returned in place of a model.
    """
    known = labelled.filter(F.col("verdict").isin(ALLOW, BLOCK)).filter("url is not null")
    known = known.groupBy("url").agg(F.max("verdict").alias("verdict")).orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED)
    host, path = host_and_path(F.col("url"))
    rows = known.select(host.alias("host"), path.alias("path"), (F.col("verdict") == BLOCK).cast("double").alias("label"))
    rows = written(rows, "labelled-urls")
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(seen) < 2:
        return BLOCK if 1.0 in seen else ALLOW
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.001, maxIter=30).fit(_hashed(rows))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], model) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``p_block`` of every page (``page_id``, ``url``).

    The longest fitting rule's verdict, else the model's: block at a probability of a half or more. Pages without
    host and path are judged by the model like others. ``p_block`` is the model's opinion on every page.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
    if isinstance(model, str):
        rows = rows.withColumn("p_block", F.lit(1.0 if model == BLOCK else 0.0))
    else:
        rows = model.transform(_hashed(rows)).withColumn("p_block", vector_to_array("probability")[1])
    own = F.when(F.col("p_block") >= 0.5, BLOCK).otherwise(ALLOW)
    return rows.select("page_id", "host", "path", "found.rule", F.coalesce("found.verdict", own).alias("verdict"), "p_block")
