"""Near-duplicates against brute force over all pairs."""

import random
import re

import pytest

from shoptrail.llm import near_dups


def word_set(text, shingle):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)}


def by_brute_force(rows, shingle, percent=80):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(word_set(text, shingle))
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in sets}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize("shingle", [4, 5])
def test_equals_brute_force(spark, docs_of, shingle):
    rng = random.Random(shingle)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5, 14])):
            rows.append((len(rows) + 1, " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 4, 9])))))
    # A chain: each is like the one before, the ends are not alike.
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):
        rows.append((len(rows) + 1, " ".join(chain[4 * i :] + [f"e{j}" for j in range(4 * i)])))
    rng.shuffle(rows)
    found = {r["doc_id"]: r for r in near_dups.near_duplicates(docs_of(rows), shingle).collect()}
    expected = by_brute_force(rows, shingle)
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert all(found[i]["n_shingles"] == len(word_set(text, shingle)) for i, text in rows)
    assert all(r["kept"] == (i == expected[i]) for i, r in found.items())


@pytest.mark.parametrize("block", [2048, 3])
def test_strangers_in_a_large_group_are_all_met(spark, docs_of, monkeypatch, block):
    """Classes whose members meet in the same keys, not at the keys' centres; also with keys cut into blocks."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    rng = random.Random(3)
    core = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(core[:150] + [f"x{i}-{j}" for j in range(45)])) for i in range(1, 8)]
    rows += [(i, " ".join(edited(rng, core, rng.choice([2, 4, 6, 8])))) for i in range(8, 60)]
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs_of(rows)).collect()}
    assert found == by_brute_force(rows, 5)


def test_odd_rows(spark, odd_docs):
    found = near_dups.near_duplicates(odd_docs, shingle=4).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert len(found) == odd_docs.count()
    assert all(r["n_shingles"] == 0 and r["component_id"] == i and r["kept"] for i in (2, 3, 4) for r in by_id[i])
    assert by_id[None][0]["component_id"] is None and by_id[None][0]["kept"]
    assert [r["n_shingles"] for r in by_id[7]] == [1] and len(by_id[1]) == 2
    kept = near_dups.without_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_empty_table(spark, docs_of):
    assert near_dups.near_duplicates(docs_of([])).collect() == []
    assert near_dups.without_near_duplicates(docs_of([])).collect() == []


def test_one_of_each_group_stays(spark, docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(9, text), (4, text.upper().replace("W", "w")), (7, text + " end"), (1, "another text of six words here")]
    kept = near_dups.without_near_duplicates(docs_of(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4]
