"""The Merkle manifest against a plain tree."""

import random
from hashlib import sha256
from zlib import crc32

import pytest

from shoptrail.llm import manifest as mf

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, place string, low bigint, hash string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, i, folded):
    proof = ""
    for level in tree[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        before, after = run[: i % 16], run[i % 16 + 1 :]
        proof, folded, i = proof + "".join(before + after), h(*before, folded, *after), i // 16
    return proof, folded


def brute_force(rows):
    lower = {i: i + 32 for i in range(65, 91)}
    sources = {}
    for row in rows:
        changed = row
        if row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
            changed = (*row[:4], row[4].translate(lower))
        sources.setdefault(row[1], []).append((row[0], leaf(row), leaf(changed)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in sources[s]])
    top, out = levels([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for i, (doc_id, own, changed) in enumerate(sources[s]):
            low, folded = climb(trees[s], i, changed)
            high, folded = climb(top, k, folded)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], h(low + high), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, "own", "own", 1, "own") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in mf.manifest(table).collect()), key=repr)


@pytest.mark.parametrize("n, sources", [(0, 1), (1, 1), (17, 1), (257, 2), (400, 300)])
def test_trees_of_many_shapes(spark, n, sources):
    rng = random.Random(n)
    names = [None, "", "é", "z", *(f"s{i}" for i in range(sources))][:sources]
    rows = [(i * 3, rng.choice(names), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "Ab Cd", "ÄB é"])) for i in range(n)]
    got = found(spark, rows)
    assert got == brute_force(rows)
    assert n < 100 or {r[-1] for r in got} == {True, False}


def test_null_and_repeated_ids_a_hot_source_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(mf, "CHUNK", 64)
    rows = [(i % 900 if i % 10 else None, "hot" if i % 3 else f"s{i % 50}", "en", i, "Text") for i in range(1200)]
    rows += rows[:5]
    assert found(spark, rows) == brute_force(rows)


def test_very_long_texts_and_names(spark):
    rows = [(1, "s" * 100_000, "en", 5, "Word " * 200_000), (5, "s" * 100_000, "en", 5, None), (13, "t", "en", 5, " " * 1_000_000)]
    assert found(spark, rows) == brute_force(rows)


def test_the_climb_is_a_recursive_query(spark):
    rows = spark.createDataFrame([(i, "s", "en", 1, "x") for i in range(40)], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    plan = mf.climbed(*mf.stored_tree(mf.leaves(rows)))._jdf.queryExecution().optimizedPlan().toString()
    assert "UnionLoop" in plan
