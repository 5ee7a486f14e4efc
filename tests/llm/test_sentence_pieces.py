"""Encoding and decoding against the sentencepiece library."""

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoptrail.llm import queries
from shoptrail.llm import sentence_pieces as sp

VOCABULARY = sp.read_model()
LIBRARY = sp._library(VOCABULARY)
SOME_TEXT = st.text(st.one_of(st.sampled_from(" ▁\n\té漢a."), st.characters(exclude_categories=["Cs"])), max_size=60)


def library_ids(text):
    return LIBRARY.encode(text, add_eos=True)


def own_ids(texts):
    ids, at = sp.encode(pa.array(texts, pa.string()), VOCABULARY)
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(SOME_TEXT, max_size=4))
def test_ids_are_the_librarys(texts):
    assert own_ids(texts) == [library_ids(x) for x in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 400), max_size=12))
def test_any_list_of_ids_decodes_as_in_the_library(ids):
    assert sp.decode(np.array(ids, np.int64), np.array([0, len(ids)]), VOCABULARY) == [LIBRARY.decode(ids)]


@pytest.mark.parametrize("text", [" " * 100_000, "▁" * 3_001 + "x", "x" * 100_000, "a " * 50_000, "0,1" * 30_000, "漢字かな" * 20_000, "\0\n\r\t" * 5_000])
def test_long_runs(text):
    assert own_ids([text, None, "", "tail"]) == [library_ids(x) for x in (text, "", "", "tail")]


@settings(max_examples=200, deadline=None)
@given(st.text("abe rst▁", min_size=1, max_size=sp.LONGEST))
def test_both_agendas_merge_alike(part):
    part = part.replace("▁", " ")
    ids, counts = sp.ids_of(pa.array([part]), VOCABULARY)
    assert ids.tolist() == [VOCABULARY.ids[x] for x in sp.merged_by_heap(part, VOCABULARY.ranks)] and counts.tolist() == [len(ids)]


def test_a_vocabulary_with_blanks_inside_pieces_is_not_cut():
    parts, at = sp.parts_of(pa.array(["a b c", "", None, "d e"]), sp.Vocabulary({}, {}, sp.Pairs.of({}, {}), [], [], [], 2, True, False, b""))
    assert parts.to_pylist() == [" a b c", " d e"] and at.tolist() == [0, 1, 1, 1, 2]


def test_other_kinds_of_models_are_refused(tmp_path):
    other = tmp_path / "m.model"
    other.write_bytes(VOCABULARY.proto + b"\x12\x02\x18\x01")  # another model type
    with pytest.raises(ValueError, match="merge-type"):
        sp.read_model(str(other))
    other.write_bytes(VOCABULARY.proto + b"\x1a\x02\x20\x01")  # repeated blanks are dropped
    with pytest.raises(ValueError, match="as it is"):
        sp.read_model(str(other))


def test_odd_rows(spark, odd_docs, docs_of):
    rows = sp.round_trip(odd_docs, VOCABULARY).collect()
    assert len(rows) == odd_docs.count() and all(r["agrees"] for r in rows)
    assert [(r["ids"], r["decoded"]) for r in rows if r["doc_id"] in (2, 3)] == [([2], ""), ([2], "")]
    assert sorted(r["decoded"] for r in rows) == sorted(r["text"] or "" for r in odd_docs.collect())
    assert sp.round_trip(docs_of([]), VOCABULARY).count() == 0
    assert [r["agrees"] for r in sp.round_trip(docs_of([(1, "x")]), VOCABULARY, check=False).collect()] == [None]


def test_decoded_lists(spark):
    table = spark.createDataFrame([(1, [22557, 28705, 2], "old"), (2, None, "old"), (3, [], "old"), (4, [None, 22557], "old")], "k int, ids array<int>, decoded string")
    got = {r["k"]: r["decoded"] for r in sp.decoded(table, VOCABULARY).collect()}
    assert got == {1: LIBRARY.decode([22557, 28705, 2]), 2: None, 3: "", 4: LIBRARY.decode([22557])}


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op11_sentence_pieces(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library_ids(texts[r["doc_id"]])
        digests = [sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), LIBRARY.decode(ids))]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["agrees"]) == (len(ids), *digests, True)
