"""Mixing sources to target weights by nested hash thresholds.

A document's hash places it on a line. Sizes are summed by source and hash bucket; running sums find the
bucket in which a source's budget ends, and only that bucket is split into finer ones, until it is one
hash. Documents below the threshold are taken once more than the others: documents are never sorted, and
a larger budget takes a superset of what a smaller one takes.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import word_count, written

WEIGHTS = (1.0, 2.0, 3.0)
MOST_REPEATS = 3

# Hashes have 60 bits and are refined by 12 bits at a time.
HASH_BITS, LEVEL_BITS = 60, 12


def place(doc_id: Column, seed: str = "mix") -> Column:
    """Where a document stands on the line of 60-bit numbers; a null id counts as empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` in words (null text: 0) and ``place`` of each row."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), place(F.col("doc_id")).alias("place"))


def source_targets(totals: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target`` for the rows (``source``, ``source_size``), one per source.

    Sources in order of code points, null last, weigh ``weights``, repeating, and share the sum of all sizes.
    A target stops at ``most`` times the source's size and the excess is shared again by weight: sources
    are filled in order of that limit by weight, up to the level which the rest of the budget gives the others.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") - 1) % len(weights) + 1)
    rows = totals.withColumn("number", number).withColumn("weight", weight)
    rows = rows.withColumn("most", (most * F.col("source_size")).cast("double")).withColumn("fill", F.col("most") / F.col("weight"))
    in_order = Window.orderBy("fill", "number")
    all_rows = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("most").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sharing = F.sum("weight").over(in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.sum("source_size").over(all_rows) - full) / sharing)
    level = F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "number", "level"))).over(all_rows)["level"]
    return rows.select("source", "source_size", F.least("most", F.coalesce(level * F.col("weight"), "most")).alias("target"))


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` with ``threshold``: sizes of a source's rows placed below it sum to about its ``rest``."""
    state = budgets.select("source", "rest", F.lit(0).cast("bigint").alias("low"), F.lit(None).cast("bigint").alias("last"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        same = F.col("sized.source").eqNullSafe(F.col("state.source"))
        offset = F.col("place") - F.col("low")
        bucket = F.shiftright(offset, shift)
        inside = sized.alias("sized").join(state.alias("state"), same).filter((offset >= 0) & (bucket < 1 << LEVEL_BITS))
        sums = inside.groupBy("state.source", bucket.alias("bucket")).agg(F.sum("size").alias("last"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.coalesce(F.sum("last").over(run), F.lit(0))).alias("sums")
        # The one bucket in which the budget ends; it alone is looked into at the next level.
        ends = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("sums.last"))
        same = F.col("sums.source").eqNullSafe(F.col("state.source"))
        low = F.col("low") + F.shiftleft(F.coalesce("bucket", F.lit(0)), shift)
        rest = F.col("rest") - F.coalesce("before", F.lit(0))
        state = state.alias("state").join(sums, same & ends, "left")
        state = written(state.select("state.source", rest.alias("rest"), low.alias("low"), F.col("sums.last").alias("last")), "thresholds")
    nearer = F.coalesce(2 * F.col("rest") >= F.col("last"), F.lit(False))
    found = state.select("source", (F.col("low") + nearer.cast("int")).alias("threshold")).alias("found")
    same = F.col("found.source").eqNullSafe(F.col("budgets.source"))
    return budgets.alias("budgets").join(found, same).select("budgets.*", "threshold")


def plan(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``repeats`` of every document, ``threshold`` below which it is taken once more."""
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = source_targets(totals, weights, most)
    repeats = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    budgets = targets.withColumn("repeats", repeats.cast("int"))
    budgets = written(budgets.withColumn("rest", F.col("target") - F.col("repeats") * F.col("source_size")), "budgets")
    return _thresholds(sized, budgets).drop("rest")


def _with_copies(rows: DataFrame, plan: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``copies``, how often the mix takes each, and ``columns`` of the plan."""
    copies = F.col("plan.repeats") + (place(F.col("rows.doc_id")) < F.col("plan.threshold")).cast("int")
    same = F.col("rows.source").eqNullSafe(F.col("plan.source"))
    return rows.alias("rows").join(plan.alias("plan"), same).select("rows.*", *(f"plan.{c}" for c in columns), copies.alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``copies`` of every row of ``docs``.

    A source's rows are taken whole, ``copies`` times each (``most`` at most). The words taken of a source come as
    near to its target as whole rows in order of hash allow. Rows of equal id have equal hashes and go
    together; rows without source form a source; an empty source has target 0.
    """
    sized = written(sizes(docs), "sizes")
    taken = _with_copies(sized, plan(sized, weights, most), "source_size", "target")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all their columns, and ``copies``; an older column of that name is replaced."""
    found = plan(written(sizes(docs), "sizes"), weights, most)
    return _with_copies(docs.drop("copies"), found).filter("copies > 0")
