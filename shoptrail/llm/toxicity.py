"""Toxicity by weak supervision.

Terms (words and word beginnings) that toxic texts hold far more often are found in labelled rows and dealt to many lexicon
voters; pattern voters look at the text's form or at the absence of terms. A voter says toxic, clean or nothing. A
generative label model learns by expectation maximisation, without labels, how often each voter says what on toxic and
on clean texts, and how far voters depend on each other given the class; dependent voters share a vote. Its
posterior labels train a linear classifier on terms and patterns, which scores all texts.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import slices, training_rows, written

# Bounds of what is learned: labelled rows (the first by hash of their ids), terms, lexicons per kind of term.
MAX_ROWS, MAX_TERMS, LEXICONS = 20_000, 600, 8
LEAST_TEXTS, LEAST_ODDS = 5, math.log(20)

BEGINNINGS = (4, 5, 6)
LETTERS = re.compile(r"[^\W\d_]+")
PATTERNS = ("shouting", "exclaiming", "repeating")

TOXIC, CLEAN, SILENT = 1, 2, 0

# What is believed of a voter before any vote, as counts of silent, toxic and clean votes on clean and on toxic texts.
BELIEF = np.array([[0.5, 0.1, 0.4], [0.5, 0.4, 0.1]])


def terms(text: str) -> set[str]:
    """The distinct words of a text, lower-cased, and their beginnings, marked by length (0: whole)."""
    words = set(LETTERS.findall(text.lower()))
    found = {f"0{w}" for w in words}
    for n in BEGINNINGS:
        found.update(f"{n}{w[:n]}" for w in words if len(w) > n)
    return found


def known_terms(text: str, known: dict[str, set[str]]) -> list[str]:
    """The terms of a text that are in ``known`` (by mark), without making all of them."""
    words = set(LETTERS.findall(text.lower()))
    found = [f"0{w}" for w in words & known.get("0", set())]
    for n in BEGINNINGS:
        if own := known.get(str(n)):
            found += [f"{n}{w}" for w in {w[:n] for w in words if len(w) > n} & own]
    return sorted(found)


def patterns(text: str) -> list[bool]:
    """Whether a text is mostly capitals, has a mark of exclamation in a fifth of its words, is mostly one word."""
    words = text.split()
    n = max(len(words), 1)
    letters = max(sum(map(str.isalpha, text)), 1)
    top = max(Counter(words).values(), default=0)
    return [sum(map(str.isupper, text)) > 0.5 * letters, text.count("!") > 0.2 * n, top > 0.5 * n and n > 3]


def _by_mark(found: list[str]) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for term in found:
        out.setdefault(term[0], set()).add(term[1:])
    return out


def telling_terms(rows: DataFrame) -> list[str]:
    """The terms of ``rows`` (``text``, ``label``) that toxic texts hold at least twenty times as often, the best first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            by_label = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                by_label[label == 1].update(terms(text or ""))
            for label, counter in enumerate(by_label):
                columns = [pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([label] * len(counter), pa.int64())], ["term", "n", "label"])

    n = {r["label"]: r["count"] for r in rows.groupBy((F.col("label") == 1).cast("int").alias("label")).count().collect()}
    counts = rows.select("text", "label").mapInArrow(count, "term string, n bigint, label bigint").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    best = counts.filter(F.col("toxic") >= LEAST_TEXTS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    return [r["term"] for r in best.orderBy(F.desc("odds"), "term").limit(MAX_TERMS).collect()]


def votes(held: list[list[int]], forms: np.ndarray, chosen: list[str]) -> np.ndarray:
    """The votes of every voter on every text, from the indices of the terms it holds and its patterns.

    Lexicon voters: the terms of a kind dealt to ``LEXICONS`` lists by rank; toxic if one is held, else silent. Voters
    on what is missing: clean if no term of a kind, or none at all, is held. Pattern voters say clean: junk has
    other reasons to look odd.
    """
    kinds = ["0", *map(str, BEGINNINGS)]
    lists = {(kind, i): np.zeros(len(chosen), bool) for kind in kinds for i in range(LEXICONS)}
    rank: Counter = Counter()
    for i, term in enumerate(chosen):
        lists[term[0], rank[term[0]] % LEXICONS][i] = True
        rank[term[0]] += 1
    has = np.zeros((len(held), len(chosen)), bool)
    for i, found in enumerate(held):
        has[i, found] = True
    columns = [np.where(has[:, members].any(1), TOXIC, SILENT) for members in lists.values() if members.any()]
    for kind in kinds:
        members = np.array([t[0] == kind for t in chosen], bool)
        if members.any():
            columns.append(np.where(has[:, members].any(1), SILENT, CLEAN))
    columns.append(np.where(has.any(1), SILENT, CLEAN))
    columns.append(np.where(has.sum(1) >= 2, TOXIC, SILENT))
    columns += [np.where(form & ~has.any(1), CLEAN, SILENT) for form in forms.T]
    return np.stack(columns, 1)


def label_model(ballots: np.ndarray, share: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of toxic for each text, each voter's table P(vote | class), and the voters' weights.

    ``share`` is the share of toxic texts, which a few voters could not tell. Weights are 1 over the sum of a voter's absolute
    correlations with all voters inside the classes, so copies of one voter weigh as one.
    """
    n, k = ballots.shape
    one_hot = np.stack([ballots == v for v in (SILENT, TOXIC, CLEAN)], 2).astype(float)
    signs = one_hot[:, :, 1] - one_hot[:, :, 2]
    # At first only voters that nearly always agree count as copies; a majority of the others leads.
    rest = signs - signs.mean(0)
    spread = np.sqrt((rest**2).mean(0)) + 1e-6
    alike = np.abs((rest.T @ rest) / max(n, 1) / np.outer(spread, spread))
    np.fill_diagonal(alike, 1)
    weights = 1 / np.where(alike > 0.8, alike, 0).sum(1)
    posterior = np.where(signs @ weights > 0, 0.9, 0.1 * share)
    tables = np.zeros((2, k, 3))
    for _ in range(rounds):
        for c, weight in enumerate((1 - posterior, posterior)):
            tables[c] = (np.einsum("n,nkv->kv", weight, one_hot) + BELIEF[c]) / (weight.sum() + BELIEF[c].sum())
        means = np.stack([((1 - posterior) @ signs) / max((1 - posterior).sum(), 1e-9), (posterior @ signs) / max(posterior.sum(), 1e-9)])
        rest = signs - (1 - posterior)[:, None] * means[0] - posterior[:, None] * means[1]
        spread = np.sqrt((rest**2).mean(0)) + 1e-6
        correlation = np.abs((rest.T @ rest) / n / np.outer(spread, spread))
        np.fill_diagonal(correlation, 1)
        weights = 1 / np.where(correlation > 0.2, correlation, 0).sum(1)
        odds = math.log(share / (1 - share)) + np.einsum("nkv,kv,k->n", one_hot, np.log(tables[1] / tables[0]), weights)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, tables, weights


@dataclass
class Linear:
    """Weights of the terms and of the patterns, and the bias, as log odds."""

    chosen: list[str]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        known, at = _by_mark(self.chosen), {t: i for i, t in enumerate(self.chosen)}
        n = len(self.chosen)
        odds = [
            self.bias + sum(self.weights[at[t]] for t in known_terms(text, known)) + float(self.weights[n:] @ np.array(patterns(text), float))
            for text in texts
        ]
        return 1 / (1 + np.exp(-np.clip(np.array(odds, float), -30, 30)))


def linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 20) -> tuple[np.ndarray, float]:
    """Logistic regression to probabilities ``y`` by Newton's steps with a ridge; the bias has almost none."""
    rows = np.concatenate((x, np.ones((len(x), 1))), 1)
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        hessian = (rows * (p * (1 - p) + 1e-6)[:, None]).T @ rows + np.diag(penalty)
        w += np.clip(np.linalg.solve(hessian, rows.T @ (y - p) - penalty * w), -4, 4)
    return w[:-1], float(w[-1])


def one_of_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with one row (of the smallest id) per pair of least word hashes, which copies and most near copies
    share: words of a text that was copied often must not look telling."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    least = [F.array_min(F.transform(words, lambda w: F.xxhash64(F.concat(w, F.lit(mark))))).alias(mark) for mark in ("a", "b")]
    keys = rows.select("doc_id", *least).groupBy("a", "b").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(keys.select("doc_id"), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", divisor: int = 3, held_out: int = 1, limit: int = MAX_ROWS) -> Linear:
    """A classifier from at most ``limit`` labelled rows whose id's remainder is not ``held_out``.

    Labels only tell which terms make the lexicons and the share of toxic texts; what the classifier is trained on is
    the label model's posterior. Without a telling term every text gets the labels' smoothed share.
    """
    rows = written(training_rows(docs, labels, label, divisor, held_out, limit).select("doc_id", "text", "label"), "labelled")
    rows = written(one_of_copies(rows), "labelled")
    chosen = telling_terms(rows)
    seen = rows.agg(F.count("*").alias("n"), F.sum((F.col("label") == 1).cast("int")).alias("toxic")).first()
    share = ((seen["toxic"] or 0) + 1) / (seen["n"] + 2)
    if not chosen:
        return Linear([], np.zeros(len(PATTERNS)), math.log(share / (1 - share)))
    known, at = _by_mark(chosen), {t: i for i, t in enumerate(chosen)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            held = pa.array([[at[t] for t in known_terms(text, known)] for text in texts], pa.list_(pa.int32()))
            forms = pa.array([patterns(text) for text in texts], pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), held, forms], ["doc_id", "held", "forms"])

    found = rows.mapInArrow(look, f"doc_id {dict(rows.dtypes)['doc_id']}, held array<int>, forms array<boolean>").toArrow()
    held = sorted(zip(found.column("held").to_pylist(), found.column("forms").to_pylist()))  # whatever order they came in
    forms = np.array([f for _, f in held], bool).reshape(len(held), len(PATTERNS))
    held = [h for h, _ in held]
    posterior, _, _ = label_model(votes(held, forms, chosen), share)
    x = np.zeros((len(held), len(chosen) + len(PATTERNS)))
    for i, indices in enumerate(held):
        x[i, indices] = 1
    x[:, len(chosen) :] = forms
    return Linear(chosen, *linear(x, posterior))


def score(docs: DataFrame, model: Linear, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (1 from the threshold on) of each row; a null text is scored as empty."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = model.score([text or "" for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int"
    return docs.select("doc_id", "text").mapInArrow(judge, schema)
