import pytest

import duckdb

from shoptrail.llm import decontaminate, oracles

ITEM = "Anna Weber buys 12 apples for 3 euros each and gives 5 apples to her brother Tom before she walks 4 km to the old market in town"


@pytest.fixture
def benchmark(spark):
    rows = [(1, ITEM), (2, "too short"), (3, ""), (4, None), (None, ITEM), (5, "the river runs slowly past seven green hills and into the wide cold sea")]
    return spark.createDataFrame(rows, "item_id long, text string")


def held(docs, benchmark, **options):
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, benchmark, **options).collect()}


def test_copies_and_reparameterised_items_are_found(docs_of, benchmark):
    other = ITEM.replace("Anna Weber", "Eva Braun").replace("12", "31").replace("Tom", "Max").replace("4 km", "9 miles")
    rows = [
        (1, f"before it. {ITEM} after it."),
        (2, f"Before it {other} after"),
        (3, ITEM.upper()),
        (4, "clean words that only mention Anna and 12 apples for 3 euros"),
        (5, " ".join(ITEM.split()[:9])),
        (6, ITEM.replace(" ", "  \n")),
    ]
    found = held(docs_of(rows), benchmark)
    assert set(found) == {(1, 1), (2, 1), (3, 1), (6, 1)}
    assert found[1, 1]["exact"] and found[6, 1]["exact"] and not found[2, 1]["exact"]


def test_slots_must_be_consistent(docs_of, spark):
    item = "x is 5 and y is 5 so the sum of 5 and 5 is ten in all"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.replace("5", "8")), (2, "x is 1 and y is 2 so the sum of 3 and 4 is ten in all")]
    assert set(held(docs_of(rows), benchmark)) == {(1, 1)}


def test_several_places_and_a_gap(docs_of, benchmark):
    """An insertion shifts the rest; both parts count."""
    words = ITEM.split()
    rows = [(1, " ".join([*words[:13], "inserted", *words[13:]])), (2, f"{ITEM} {ITEM.replace('12', '40')}")]
    found = held(docs_of(rows), benchmark)
    assert set(found) == {(1, 1), (2, 1)} and found[1, 1]["matched"] < found[1, 1]["windows"]


def test_an_inserted_word_does_not_make_slots_inconsistent(docs_of, spark):
    """Past the insertion a repeated name would be compared with the word before it."""
    item = "Anna Weber buys ripe apples at the old market near the river and later that day the baker says that Anna Weber sold most of them to her brother"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    other = item.replace("Anna", "Eva").replace("Weber", "Braun")
    found = held(docs_of([(i, t.replace("later that", "later inserted that")) for i, t in enumerate((item, other))]), benchmark)
    assert {k: r["exact"] for k, r in found.items()} == {(0, 1): True, (1, 1): False}


def test_equal_words_count_where_slots_differ(docs_of, spark):
    """One of two equal values changed: as a template it is inconsistent, but most windows are the item's own words."""
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    text = lambda one, two: " ".join(["has", one, *words, two, "left"])
    benchmark = spark.createDataFrame([(1, text("7", "7"))], "item_id long, text string")
    found = held(docs_of([(1, text("7", "8")), (2, text("7", "7"))]), benchmark)
    assert set(found) == {(1, 1), (2, 1)} and found[2, 1]["exact"] and not found[1, 1]["exact"]
    assert found[1, 1]["matched"] < found[1, 1]["windows"] == found[2, 1]["matched"]


def test_odd_rows(odd_docs, benchmark):
    assert held(odd_docs, benchmark) == {}
    kept = decontaminate.without_benchmark(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_empty_tables(docs_of, benchmark):
    assert held(docs_of([]), benchmark) == {}
    docs = docs_of([(1, ITEM)])
    assert decontaminate.without_benchmark(docs, benchmark.limit(0)).count() == 1
    assert decontaminate.without_benchmark(docs, benchmark).count() == 0


def test_a_large_benchmark_is_shuffled_with_the_same_result(docs_of, benchmark, monkeypatch):
    docs = docs_of([(1, ITEM), (2, "clean " * 30)])
    few = held(docs, benchmark)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert held(docs, benchmark) == few != {}


def test_sql_states_the_same_rule(docs_of, spark):
    """The cases that the given tables do not hold: insertions, changed and inconsistent slots, short items, capitals."""
    inserted = "Anna Weber buys ripe apples at the old market near the river and later that day the baker says that Anna Weber sold most of them to her brother"
    other = inserted.replace("Anna", "Eva").replace("Weber", "Braun")
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    text = lambda one, two: " ".join(["has", one, *words, two, "left"])
    same = "x is 5 and y is 5 so the sum of 5 and 5 is ten in all"
    items = [(1, ITEM), (2, inserted), (3, text("7", "7")), (4, same), (5, "What is 2+2?"), (6, ""), (7, None)]
    texts = [inserted.replace("later that", "later inserted that"), other.replace("later that", "later inserted that"), text("7", "8"), text("7", "7"), text("9", "9"),
             same.replace("5", "8"), "x is 1 and y is 2 so the sum of 3 and 4 is ten in all", ITEM.upper(), f"{ITEM} {ITEM.replace('12', '40')}", "What is 2+2?", "1,2,3 " * 50, None, ""]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.contaminated(docs_of(list(enumerate(texts))), benchmark).select("doc_id", "item_id", "windows", "matched", "exact").collect())
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    db.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = sorted(db.sql(oracles.contaminated()).fetchall())
    assert got == want and {(0, 2), (1, 2), (2, 3), (5, 4), (7, 1)} <= {r[:2] for r in got} and (6, 4) not in {r[:2] for r in got}


def test_long_runs_of_numbers_and_blanks(docs_of, benchmark):
    runs = [",".join(map(str, range(100_000))), "1." * 100_000, " " * 5_000_000, "x" * 1_000_000, f"{'7,' * 50_000}1 {ITEM}"]
    assert set(held(docs_of(list(enumerate(runs))), benchmark)) == {(4, 1)}
