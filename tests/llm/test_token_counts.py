import random

import numpy as np
import pytest

from shoptrail.llm import token_counts as tc

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoding():
    return tc.encoder(tc.read_ranks(tc.VOCABULARY))


@pytest.mark.parametrize("text", ["", "plain words here", "é漢字 \U0001f600\U0001f680 ñandú\n\n x", "\n\n\n", "a" * 500, "ß\u0301" * 40])
def test_spans_give_back_the_text(encoding, text):
    first, after = tc.token_spans(text, *encoding)
    ids = encoding[0].encode_ordinary(text)
    assert b"".join(map(encoding[0].decode_single_token_bytes, ids)) == text.encode()
    data = 0
    for token, a, b in zip(ids, first, after):
        piece = encoding[0].decode_single_token_bytes(token)
        own = text.encode()[data : data + len(piece)]
        data += len(piece)
        covered = text[a : max(b, a + 1)].encode()
        assert own == piece and own in covered
    assert len(text) == (after[-1] if len(after) else 0)


def by_brute_force(first, after, sections, rule):
    counts = [0.0] * len(sections)
    for a, b in zip(first, np.maximum(after, first + 1)):
        parts = [max(0, min(b, e) - max(a, s)) for s, e in sections]
        if rule == "share":
            counts = [c + p / (b - a) for c, p in zip(counts, parts)]
        elif any(parts):
            place = {"start": a, "end": b - 1}.get(rule)
            if place is None:
                counts[parts.index(max(parts))] += 1
            else:
                for i, (s, e) in enumerate(sections):
                    counts[i] += s <= place < e
    return counts


@pytest.mark.parametrize("rule", tc.RULES)
def test_rules_equal_brute_force(encoding, rule):
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice(["word ", "é", "\n", "\U0001f600", "longer", " ", "12"]) for _ in range(rng.randrange(40)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randrange(6))))
        sections = [(a, b) for a, b in zip(cuts[::2], cuts[1::2]) if a < b]
        first, after = tc.token_spans(text, *encoding)
        starts, ends = (np.array([s[i] for s in sections], np.int64) for i in (0, 1))
        assert tc.attributed(first, after, starts, ends, rule) == pytest.approx(by_brute_force(first, after, sections, rule))


def test_lines_of_a_table(spark, encoding):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = tc.token_counts(docs).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, own in rows.groupby("doc_id"):
        text = texts[doc_id]
        assert own["n_tokens"].sum() == len(encoding[0].encode_ordinary(text)) == own["doc_tokens"].iloc[0]
        own = own.sort_values("section")
        assert [text[a:b] for a, b in zip(own["start"], own["end"])] == [line + "\n" for line in text.split("\n")[:-1]] + [text.split("\n")[-1]]


def test_given_sections(spark):
    rows = [(1, "title body text", [(0, 5), (6, 15)]), (2, "abc", []), (3, "abc", None), (4, None, [(0, 0)])]
    schema = "doc_id long, text string, parts array<struct<start:int,end:int>>"
    found = tc.token_counts(spark.createDataFrame(rows, schema), "parts", "share").collect()
    assert {(r["doc_id"], r["section"], r["start"], r["end"]) for r in found} == {(1, 0, 0, 5), (1, 1, 6, 15), (4, 0, 0, 0)}
    assert sum(r["n_tokens"] for r in found) < found[0]["doc_tokens"] <= 4
    with pytest.raises(ValueError):
        tc.token_counts(spark.createDataFrame(rows, schema), rule="other")


def test_odd_rows(odd_docs, docs_of):
    found = tc.token_counts(odd_docs).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["section"], r["n_tokens"], r["doc_tokens"]) for r in by_id[2]] == [(0, 0, 0)] and len(by_id[1]) == 2 and len(by_id[None]) == 1
    assert len(by_id[4]) == 2 and tc.token_counts(docs_of([])).collect() == []


@pytest.mark.parametrize("text", [" " * 5_000_000, "a" + "\n" * 1_500_000 + "b", "x " + "\t" * 1_200_000 + " y"])
def test_long_runs_of_blanks(docs_of, text):
    rows = tc.token_counts(docs_of([(1, text)]).limit(1)).agg({"n_tokens": "sum", "doc_tokens": "max"}).first()
    assert rows[0] == rows[1] > 0


def test_cut_runs_encode_alike(monkeypatch):
    monkeypatch.setattr(tc, "LONG_RUN", 5)
    encoding, _ = tc.encoder(tc.read_ranks(tc.VOCABULARY))
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice([" ", "\n", "\t", "\r\n", "\u00a0", "\x1c", "a", "é", "1", "."]) * rng.choice([1, 1, 2, 7]) for _ in range(rng.randrange(12)))
        assert tc._ids(text, encoding) == encoding.encode_ordinary(text)
