import numpy as np
import pytest

from shoptrail.llm import toxicity
from shoptrail.llm.common import remainder

SF_DIR = "/root/testdata/sf0.1"


def test_terms():
    assert toxicity.terms("Ab, badword! ab") == {"0ab", "0badword", "4badw", "5badwo", "6badwor"}
    known = {"0": {"ab"}, "5": {"badwo"}, "6": {"nothin"}}
    assert toxicity.known_terms("Ab, badword! ab", known) == ["0ab", "5badwo"]
    assert toxicity.patterns("") == [False] * 3 and toxicity.patterns("GO GO GO GO!!") == [True, True, True]


def test_label_model_finds_accuracies_and_copies():
    """Good voters, weak voters, and six copies of one bad voter that would win a majority."""
    rng = np.random.default_rng(0)
    truth = rng.random(6000) < 0.3
    noisy = lambda right: np.where(rng.random(6000) < right, np.where(truth, 1, 2), np.where(truth, 2, 1))
    bad = noisy(0.6)
    ballots = np.stack([noisy(0.9), noisy(0.85), noisy(0.9), noisy(0.7), *[bad] * 6], 1)
    posterior, tables, weights = toxicity.label_model(ballots, 0.3)
    assert weights[4:].max() < 0.25 and weights[:3].min() > 2 * weights[4:].max()
    majority = (ballots == 1).sum(1) > (ballots == 2).sum(1)
    assert ((posterior > 0.5) == truth).mean() > max(0.9, (majority == truth).mean())
    assert tables[1, 0, 1] == pytest.approx(0.9, abs=0.05) and tables[0, 3, 2] == pytest.approx(0.7, abs=0.07)


def test_linear_classifier_learns_soft_labels():
    rng = np.random.default_rng(1)
    x = (rng.random((3000, 6)) < 0.3).astype(float)
    p = 1 / (1 + np.exp(-(x @ np.array([3, -2, 0, 0, 1, 0]) - 1)))
    w, b = toxicity.linear(x, p)
    assert np.allclose(w, [3, -2, 0, 0, 1, 0], atol=0.05) and b == pytest.approx(-1, abs=0.05)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).join(labels, "doc_id").filter(remainder(labels["doc_id"], 3) == 1).toPandas()
    hit, alarms = ((scored["predicted"] == 1) & (scored["toxic"] == v) for v in (1, 0))
    assert hit.sum() >= 0.7 * (scored["toxic"] == 1).sum() and alarms.sum() <= 0.01 * (scored["toxic"] == 0).sum()


def test_odd_rows(spark, odd_docs, docs_of):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (8, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for docs in (odd_docs, docs_of([])):
        found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    plain = lambda i: " ".join(f"w{(i * 7919 + j * 104729) % 5003}x" for j in range(12))
    insults = lambda i: " ".join(w for k, w in enumerate(["vile", "rotten", "nasty", "foul"]) if k != i // 3 % 4)
    many = docs_of([(i, f"{plain(i)} {insults(i) if i % 3 == 0 else 'fine'} {plain(i + 1000)}") for i in range(90)])
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(many, marks)
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(many, model).collect()}
    assert found == {i: int(i % 3 == 0) for i in range(90)}
    assert toxicity.score(docs_of([(1, None), (2, "")]), model).agg({"predicted": "max"}).first()[0] == 0
