"""Benchmark decontamination by templates, with DataFrame functions only.

Numbers, units and capitalised names become typed placeholders, so a question asked again with other
values has the same template. Windows of template tokens are hash-joined with those of the benchmark;
documents that hold most windows of an item are aligned with it, and an alignment counts only if its slots
are consistent: a value of the item always became the same value in the document, as far as windows match at
that shift; past an inserted word they match at another. Beside the templates the words themselves are compared
in lower case, as in text all in capitals no name can be told; equal words need no slots.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import let, written

WINDOW, COVERAGE = 5, 80

# Benchmark windows broadcast at most (16 bytes each); a larger benchmark is joined by a shuffle.
BROADCAST_WINDOWS = 500_000

# Possessive, as the engine runs such groups as loops: a long run of numbers must not fill its stack.
TOKEN = r"[0-9]++(?:[.,][0-9]++)*+|\p{L}[\p{L}\p{M}]*|[%$€£°]"

# Words that are a unit when they follow a number; the signs always are.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet meter meters metre metres mg g kg t lb lbs oz pound pounds "
    "ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent dollar dollars euro euros cent cents usd eur gbp kb mb gb tb hz khz mhz ghz w kw kwh v mph kmh"
).split()


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _is_number(token: Column) -> Column:
    return token.rlike("^[0-9]")


def kind(token: Column, before: Column) -> Column:
    """``#`` number, ``u`` unit, ``@`` name (capital, then a small letter), else null: a plain word."""
    unit = token.rlike("^[%$€£°]") | (F.lower(token).isin(UNITS) & F.coalesce(_is_number(before), F.lit(False)))
    return F.when(_is_number(token), "#").when(unit, "u").when(token.rlike(r"^\p{Lu}\p{Ll}"), "@")


def _typed(found: Column, use) -> Column:
    """``use(token, kind)`` of each token; kinds look at the token before."""
    before = lambda i: F.when(i > 0, F.get(found, i - 1))
    return F.transform(found, lambda x, i: use(x, kind(x, before(i))))


def template_hashes(found: Column) -> Column:
    """The hash of each token's template form: its placeholder, or the lower-cased word."""
    return _typed(found, lambda x, k: F.xxhash64(F.coalesce(k, F.lower(x))))


def _runs(hashes: Column, window: int) -> Column:
    starts = F.when(F.size(hashes) >= window, F.sequence(F.lit(1), F.size(hashes) - (window - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, window)))


def word_hashes(found: Column) -> Column:
    """The hash of each token as it is, in lower case."""
    return F.transform(found, lambda x: F.xxhash64(F.lower(x)))


def window_hashes(text: Column, window: int = WINDOW) -> Column:
    """Hashes of each run of ``window`` tokens, in order: of its template, then of its words. Null texts have none."""
    both = lambda found: F.array(template_hashes(found), word_hashes(found))
    return let(tokens(text), lambda found: F.transform(both(found), lambda hashes: _runs(hashes, window)))


def _slots(table: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """A row per placeholder: ``key``, its position, ``kind`` and ``value``."""
    both = lambda x, k: F.struct(k.alias("kind"), F.lower(x).alias(value))
    typed = let(tokens(F.col("text")), lambda found: _typed(found, both))
    rows = table.select(key, F.posexplode(typed).alias(position, "slot"))
    return rows.filter("slot.kind is not null").select(key, position, "slot.kind", f"slot.{value}")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """``doc_id``, ``item_id``, ``windows``, ``matched``, ``exact`` per document and benchmark item it holds.

    An item is held if at least ``coverage`` percent of its distinct windows stand in the document, word for word
    or as templates within alignments whose slots are consistent. ``exact`` says that all slot values are the item's
    own, from the first to the last window that matches at a shift. Items
    shorter than a window, empty or null hold nothing and are held by nothing; rows without id are left out.
    Rows of the same id count as one document or item each, whose windows are united.
    """
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    items = benchmark.select("item_id", "text").filter("item_id is not null")
    windows = window_hashes(F.col("text"), window)
    forms = items.select("item_id", F.posexplode(windows).alias("form", "windows"))
    item_rows = forms.select("item_id", "form", F.posexplode("windows").alias("item_at", "hash"))
    item_rows = written(item_rows.distinct(), "item-windows")
    known = item_rows.select("item_id", "form", "hash").distinct()
    sizes = known.groupBy("item_id", "form").agg(F.count("*").alias("windows"))
    few = item_rows.count() <= BROADCAST_WINDOWS
    small = F.broadcast if few else (lambda table: table)
    enough = 100 * F.col("matched") >= coverage * F.col("windows")

    doc_rows = docs.select("doc_id", F.explode(F.array_distinct(F.flatten(windows))).alias("hash"))
    held = doc_rows.join(small(known), "hash").groupBy("doc_id", "item_id", "form").agg(F.count_distinct("hash").alias("matched"))
    held = held.join(small(sizes), ["item_id", "form"]).filter(enough)
    held = written(held.select("doc_id", "item_id", "form", "windows"), "held")

    # Only documents with a candidate are aligned and their slots compared.
    texts = written(docs.join(held.select("doc_id").distinct(), "doc_id", "left_semi"), "held-texts")
    placed = texts.select("doc_id", F.posexplode(windows).alias("form", "windows"))
    placed = placed.select("doc_id", "form", F.posexplode("windows").alias("at", "hash"))
    aligned = placed.join(held, ["doc_id", "form"]).join(item_rows, ["item_id", "form", "hash"])
    shift = F.col("at") - F.col("item_at")
    aligned = written(aligned.select("doc_id", "item_id", "form", "windows", shift.alias("shift"), "item_at", "hash"), "aligned")
    shifts = aligned.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set(F.when(F.col("form") == 0, F.col("item_at"))).alias("starts"),
        F.min("item_at").alias("first"), (F.max("item_at") + (window - 1)).alias("last"),
    )
    item_slots = _slots(items, "item_id", "item_at", "item_value")
    doc_slots = _slots(texts, "doc_id", "at", "doc_value")
    pairs = shifts.join(small(item_slots), "item_id").filter("item_at between first and last")
    covered = F.exists("starts", lambda start: F.col("item_at").between(start, start + (window - 1)))
    pairs = pairs.select("doc_id", "item_id", "shift", "kind", "item_value", (F.col("item_at") + F.col("shift")).alias("at"), covered.alias("covered"))
    pairs = pairs.join(doc_slots, ["doc_id", "at", "kind"])
    matched = F.when(F.col("covered"), F.col("doc_value"))
    values = pairs.groupBy("doc_id", "item_id", "shift", "kind", "item_value").agg(
        (F.min(matched) != F.max(matched)).alias("mixed"), F.max(F.col("doc_value") != F.col("item_value")).alias("changed")
    )
    slots = values.groupBy("doc_id", "item_id", "shift").agg(F.max("mixed").alias("mixed"), F.max("changed").alias("changed"))
    fitting = aligned.join(slots, ["doc_id", "item_id", "shift"], "left").filter((F.col("form") == 1) | ~F.coalesce("mixed", F.lit(False)))
    agreed = fitting.groupBy("doc_id", "item_id", "form", "windows").agg(
        F.count_distinct("hash").alias("matched"), (~F.max(F.coalesce("changed", F.lit(False)))).alias("exact")
    )
    best = agreed.filter(enough).groupBy("doc_id", "item_id").agg(F.max(F.struct("matched", "windows", "exact")).alias("best"))
    return best.select("doc_id", "item_id", "best.windows", "best.matched", "best.exact")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    held = written(contaminated(docs, benchmark, window, coverage).select("doc_id").distinct(), "contaminated")
    return docs.join(held, "doc_id", "left_anti").select(*docs.columns)
