import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shoptrail.llm import fingerprints as fp

SF_DIR = "/root/testdata/sf0.001"


def print_of(text):
    return fp.fingerprint(text.encode(), fp.Powers())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_length_equals_dynamic_programming():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(70))) for _ in range(2))
        assert fp._common_length(a, b) == lcs(a, b)


def test_edits_change_a_fingerprint_locally():
    rng = random.Random(4)
    text = " ".join(f"word{rng.randrange(5000)}" for _ in range(800))
    other = " ".join(f"word{rng.randrange(5000)}" for _ in range(800))
    middle = text[:3000] + "some new words" + text[3000:]
    own = print_of(text)
    assert fp.likeness(own, own) == 1 and fp.likeness(own, print_of(middle)) > 0.85
    assert fp.likeness(own, print_of(text[:4000] + other[:2000])) > 0.5 > fp.likeness(own, print_of(other))
    assert fp.likeness(own, print_of(text * 8)) == 0 and fp.likeness(own, print_of("")) == 0
    # Twice the text has twice the block size: the second signature of one meets the first of the other.
    n = len(text)
    long = text + other[: n // 2]
    assert fp.block_size(len(long)) in (fp.block_size(n), 2 * fp.block_size(n)) and fp.likeness(own, print_of(long)) > 0.4


def test_pieces_do_not_depend_on_their_place():
    """A signature's characters come from the pieces alone, so what stands before a trigger does not matter after it."""
    rng = random.Random(6)
    tail = "".join(chr(rng.randrange(97, 123)) for _ in range(600))
    one, two = (print_of(head + tail).split(":") for head in ("x" * 300, "y" * 300))
    assert one[0] == two[0] and one[1][-20:] == two[1][-20:]


def expected(rows):
    return in_turn(sorted(rows, key=lambda r: -r[0]))


def in_turn(ordered):
    for (doc_id, text), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        text, following = text or "", following or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        prints = [print_of(x) for x in (text, edited, following)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        yield (doc_id, len(text), digest, prints[0], prints[1], fp.likeness(prints[0], prints[1]), fp.likeness(prints[0], prints[2]))


@pytest.mark.parametrize("partitions", ["1", "4", "97"])
def test_against_next_equals_brute_force(spark, partitions):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = sorted(tuple(r) for r in fp.against_next(docs).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found == sorted(expected([(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_an_id_with_a_third_of_the_rows_is_spread(docs_of):
    rows = [(7, f"text {i} of one id, " * (1 + i % 3)) for i in range(60)] + [(7, "the same text again")] * 40 + [(i, f"own {i} " * 9) for i in range(100, 300)]
    docs = docs_of(rows)
    turn = docs.orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text")).select("doc_id", "text").collect()
    assert sorted(tuple(r) for r in fp.against_next(docs).collect()) == sorted(in_turn([tuple(r) for r in turn]))


def test_small_and_odd_tables(odd_docs, docs_of):
    assert fp.against_next(docs_of([])).collect() == []
    one = [tuple(r) for r in fp.against_next(docs_of([(5, "abcdef")])).collect()]
    assert one == list(expected([(5, "abcdef")])) and one[0][2] == hashlib.sha256(b"abcdab").hexdigest()
    rows = [(1, "abc"), (3, None), (2, "")]
    assert sorted(tuple(r) for r in fp.against_next(docs_of(rows)).collect()) == sorted(expected(rows))
    found = fp.against_next(odd_docs).collect()
    assert len(found) == odd_docs.count()
    same = [r["fingerprint"] for r in found if r["doc_id"] == 1]
    assert same[0] == same[1] and {r["fingerprint"] for r in found if r["doc_id"] in (2, 3)} == {"4::"}


def test_fingerprints_keep_all_columns(odd_docs):
    result = fp.fingerprints(odd_docs)
    assert set(result.columns) == set(odd_docs.columns) and result.count() == odd_docs.count()
    assert all(r["fingerprint"] == print_of(r["text"] or "") for r in result.collect())
