"""Hard negatives against brute force over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptrail.llm import hard_negatives as hn
from shoptrail.llm.common import written

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, window string, found string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "s", "w", "f") for i, v, label in rows], SCHEMA)


def brute_force(rows):
    """The contract read literally, over rows (vec_id, embedding, label)."""
    rows = [r for r in rows if None not in r and all(x is not None and np.isfinite(x) for x in r[1])]
    longest = max((len(r[1]) for r in rows), default=0)
    ids = [r[0] for r in rows]
    labels = [(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in rows]
    vectors = [[int(np.floor(256 * float(np.float32(x)))) for x in r[1]] + [0] * (longest - len(r[1])) for r in rows]
    out = []
    for a in range(len(rows)):
        if ids[a] % 100:
            continue
        score = lambda i: sum(x * y for x, y in zip(vectors[a], vectors[i]))
        order = sorted((-score(i), ids[i], i) for i in range(len(rows)) if ids[i] != ids[a])
        for p, positive, _ in [x for x in order if labels[x[2]] == labels[a]][:5]:
            fits = [x for x in order if labels[x[2]] != labels[a] and 80 * -p <= 100 * -x[0] <= 100 * -p][:5]
            out += [(ids[a], positive, k + 1, negative, -p, -n) for k, (n, negative, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in hn.hard_negatives(hn.prepared(table(spark, rows)), **options).collect())


def clustered(n, clusters, d=16, spread=0.05, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    return [(i, (centres[i % clusters] + spread * rng.normal(size=d)).astype(np.float32).tolist(), int(rng.integers(10))) for i in range(n)]


@pytest.mark.parametrize("shelf", [8192, 40])
def test_random_and_clustered_rows(spark, shelf):
    rows = clustered(900, 12) + [(1000 + i, v, label) for i, v, label in clustered(300, 300, spread=1.0)]
    want = brute_force(rows)
    assert len(want) > 50 and mined(spark, rows, shelf=shelf) == want


def test_ties_and_a_vector_that_is_everywhere(spark):
    rows = [(i, [0.5, 0.25, -0.125], i % 3) for i in range(500)] + [(500 + i, [0.25, 0.5, i / 64], i % 3) for i in range(200)]
    want = brute_force(rows)
    assert want and mined(spark, rows, shelf=64) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 2], 1), (100, [1, 1, 1], 1), (1, [1, None], 1), (2, None, 1), (3, [nan, 1], 1), (4, [inf, 0], 2), (None, [1, 1], 1), (5, [1, 1], None),
            (6, [1, 1], 1), (7, [1, 1], 1), (8, [1, 1.5], 2), (9, [], 1), (10, [0.9, 1], 2), (200, [0, 0], 1), (11, [-1, -1], 1), (300, [-3, -1], 1)]
    want = brute_force(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, []) == [] and mined(spark, [(100, [], 1), (1, [], 1), (2, [], 2)]) == [(100, 1, 1, 2, 0, 0)]


def test_large_components_are_exact_or_left_out(spark):
    big = 2.0**20
    rows = [(0, [big, 1, big], 0), (1, [big, 3, big], 1), (2, [big, 2, big - 1], 2), (3, [big, 2, big - 2], 2), (4, [1e30, 1, 1], 2)]
    assert mined(spark, rows) == brute_force(rows[:-1]) != []


def test_repeated_rows_count_each_and_anchors_once(spark):
    rows = [(100, [1, 0], 1), (100, [1, 0], 1), (1, [1, 0], 1), (2, [0.9, 0], 2), (2, [0.9, 0], 2)]
    got = mined(spark, rows)
    assert [r[:4] for r in got] == [(100, 1, 1, 2), (100, 1, 2, 2)]


def test_cells_come_in_order_of_their_bounds():
    rng = np.random.default_rng(5)
    one, two = rng.normal(size=7), rng.normal(size=5)
    found = list(hn.cells_by_bound(one, two))
    assert len({(i, j) for _, i, j in found}) == 35
    assert all(b == one[i] + two[j] for b, i, j in found) and sorted((b for b, _, _ in found), reverse=True) == [b for b, _, _ in found]


def test_bounds_hold_and_searches_end_early(spark):
    rows = written(hn.prepared(table(spark, clustered(2000, 40, spread=0.02))))
    books = hn.fit(rows)
    index = hn.stored_index(rows, books)
    data = index.rows.select("vec_id", "vector", "first", "second").collect()
    vectors = np.array([np.frombuffer(r["vector"], np.int32) for r in data], float)
    for a in range(0, 200, 20):
        one, two = index.books.bounds(vectors[a])
        scores = vectors @ vectors[a]
        assert all(s <= one[r["first"]] + two[r["second"]] for s, r in zip(scores, data))
    anchors = index.rows.filter(F.col("vec_id") % 100 == 0).select(
        "vec_id", "label", "vector", F.lit(None).cast("array<bigint>").alias("windows"), F.lit(1e6).alias("need"), F.lit(None).cast("array<int>").alias("seen")
    )
    asked = hn._requests(anchors, index, 1, None)
    visited = asked.agg(F.sum(F.size("cells"))).first()[0] or 0
    assert visited < 0.5 * anchors.count() * np.count_nonzero(index.cell_sizes)
