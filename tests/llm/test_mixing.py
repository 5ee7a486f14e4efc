import random

import pytest

from shoptrail.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """The contract's words: share by weight, stop at the limit, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    limit, budget, fixed = {s: most * sizes[s] for s in order}, sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = budget - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > limit[s]]
        if not over:
            return fixed | share
        fixed |= {s: limit[s] for s in over}


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken(docs_of, seed):
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "漢", "zz", "empty"][: 5 + seed]
    rows = [(i, " ".join(["w"] * rng.randrange(1, 40)), rng.choice(names[:3] if rng.random() < 0.7 else names)) for i in range(900)]
    rows = [(i, "" if s == "empty" else t, s) for i, t, s in rows]
    found = mixing.mix(docs_of(rows)).collect()
    source = {i: s for i, _, s in rows}
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in set(source.values())}
    expected, taken = targets(sizes), dict.fromkeys(sizes, 0)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(expected[s])
        assert r["taken"] in [r["size"] * k for k in range(4)]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - expected[s]) <= 20 for s in sizes)  # half of the largest document


def test_reruns_agree_and_budgets_are_nested(docs_of):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 2}") for i in range(400)]
    one, two = (sorted(mixing.mix(docs_of(r)).collect()) for r in (rows, rows[::-1]))
    assert one == two
    low, high = ({r["doc_id"]: r["copies"] for r in mixing.mix(docs_of(rows), w).collect()} for w in ((1.0, 3.0), (1.0, 2.0)))
    assert all(low[i] <= high[i] for i in low if i % 2 == 0)


def test_odd_rows(odd_docs):
    found = mixing.mix(odd_docs).collect()
    assert len(found) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in found)
    kept = mixing.mixed(odd_docs)
    assert set(kept.columns) == set(odd_docs.columns) and dict(kept.dtypes)["copies"] == "int"


def test_empty_table_and_empty_texts(docs_of):
    assert mixing.mix(docs_of([])).collect() == []
    found = mixing.mix(docs_of([(1, None), (2, "")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2
