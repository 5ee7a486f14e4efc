"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits one lookup table per feature, then tables for the pairs whose interaction
explains most of what is left. A shallow tree over a feature's bins is fitted in each step; trees
of a feature add up to its table, so a text is scored by adding one entry per table.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from shoptrail.llm.common import slices, split_words, training_rows, word_hashes

FEATURES = (
    "log_words word_length long_words letters capitals digits marks odd_marks non_ascii line_words same_lines "
    "repeats distinct top_word common_words short_words"
).split()

# Frequent short words of the languages the texts are in.
COMMON = (
    "the of and to in a is that it for on was with as be by are this from or an at "
    "de la le les des et en un une du que dans est pour qui sur avec pas par "
    "der die das und den von zu mit auf für ein eine im ist dem nicht des "
    "el los las y por con para se lo su no al como"
).split()

# Labelled rows a model is fitted on at most; chosen by the hash of their ids.
MAX_ROWS = 20_000


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between offsets, 0 for an empty range."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text. Shares are over at least one, so empty texts give zeros."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    data = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    ends = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy())))
    # What each byte is; the bytes of longer characters count as letters and as non-ASCII.
    kind = np.zeros(256, np.uint8)
    kind[[*range(65, 91)]], kind[[*range(97, 123)]], kind[[*range(48, 58)]], kind[128:] = 1, 2, 3, 4
    kind[[x for x in range(33, 127) if not chr(x).isalnum()]] = 5
    kind[[ord(x) for x in "#$%&*|<>{}[]=~^_\\@!"]] = 6
    kind[10] = 7
    kinds = kind[data]
    size = np.maximum(ends[1:] - ends[:-1], 1)
    many = [_per_text(kinds == k, ends) for k in range(8)]
    words, at = split_words(texts)
    n_words = at[1:] - at[:-1]
    some = np.maximum(n_words, 1)
    lengths = pc.utf8_length(words).to_numpy() if len(words) else np.zeros(0)
    hashes = word_hashes(words)
    owner = np.repeat(np.arange(n), n_words)
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # Words of each text in order of hash: runs are the distinct words and their counts.
    order = np.lexsort((hashes, owner))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    starts = np.flatnonzero(first)
    runs = np.diff(np.append(starts, len(order)))
    distinct, top = np.zeros(n), np.zeros(n)
    np.add.at(distinct, owner[order][starts], 1)
    np.maximum.at(top, owner[order][starts], runs)
    common = pc.is_in(words, value_set=pa.array(COMMON)).to_numpy(zero_copy_only=False).astype(float) if len(words) else np.zeros(0)
    lines = many[7] + 1
    for i, text in enumerate(texts.to_pylist()):
        kept = [line for line in text.split("\n") if line.strip()]
        out[i, 10] = 1 - len(set(kept)) / max(len(kept), 1)
    columns = {
        "log_words": np.log1p(n_words), "word_length": _per_text(lengths, at) / some, "long_words": _per_text(lengths > 12, at) / some,
        "letters": (many[1] + many[2] + many[4]) / size, "capitals": many[1] / size, "digits": many[3] / size,
        "marks": many[5] / size, "odd_marks": many[6] / size, "non_ascii": many[4] / size, "line_words": np.log1p(n_words / lines),
        "repeats": _per_text(again, at) / some, "distinct": distinct / some ** 0.9, "top_word": top / some,
        "common_words": _per_text(common, at) / some, "short_words": _per_text(lengths <= 2, at) / some,
    }
    for name, values in columns.items():
        out[:, FEATURES.index(name)] = values
    return out


@dataclass
class Additive:
    """``base`` plus one table per feature plus one table per pair, as log odds."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        odds = np.full(len(x), self.base)
        for values, edges, table in zip(x.T, self.edges, self.tables):
            odds += table[np.searchsorted(edges, values, side="right")]
        coarse = [np.searchsorted(edges, values, side="right") for values, edges in zip(x.T, self.pair_edges)]
        for i, j, table in self.pairs:
            odds += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float) -> np.ndarray:
    """Values of a regression tree over ordered bins, by best splits of the summed gradients."""
    value = np.full(len(grad), grad.sum() / (hess.sum() + ridge))
    if depth == 0 or len(grad) < 2:
        return value
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    gain = g**2 / (h + ridge) + (grad.sum() - g) ** 2 / (hess.sum() - h + ridge)
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= grad.sum() ** 2 / (hess.sum() + ridge) + 1e-12:
        return value
    return np.concatenate([_tree(grad[:cut], hess[:cut], depth - 1, ridge), _tree(grad[cut:], hess[cut:], depth - 1, ridge)])


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Values of the best tree that cuts one axis, then each side on the other; and its gain."""
    best, values = -1.0, np.zeros_like(grad)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        for cut in range(1, g.shape[0]):
            parts = [_tree(g[s].sum(0), h[s].sum(0), 1, ridge) for s in (slice(None, cut), slice(cut, None))]
            gain = sum((p * g[s].sum(0)).sum() for p, s in zip(parts, (slice(None, cut), slice(cut, None))))
            if gain > best:
                rows = np.array([parts[0]] * cut + [parts[1]] * (g.shape[0] - cut))
                best, values = gain, rows.T if turned else rows
    return values, best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, bins: int = 32, pairs: int = 8, rate: float = 0.1, ridge: float = 4.0) -> Additive:
    """Fit the tables to 0/1 labels. Without both labels the score is the smoothed share of ones."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    k = len(FEATURES)
    quantiles = lambda n: [np.unique(np.quantile(c, np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.zeros(0) for c in x.T]
    model = Additive(base, quantiles(bins), [], quantiles(8), [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if len(np.unique(y)) < 2:
        return model
    at = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
    odds = np.full(len(y), base)
    slope = lambda: (y - (p := 1 / (1 + np.exp(-odds))), p * (1 - p))
    for _ in range(rounds):
        for i in range(k):
            residual, weight = slope()
            size = len(model.tables[i])
            step = rate * _tree(np.bincount(at[i], residual, size), np.bincount(at[i], weight, size), 2, ridge)
            model.tables[i] += step
            odds += step[at[i]]
    coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T)]
    sides = [len(e) + 1 for e in model.pair_edges]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        residual, weight = slope()
        cell, shape = coarse[i] * sides[j] + coarse[j], (sides[i], sides[j])
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (residual, weight))

    ranked = sorted(((_pair_tree(*grid(i, j), ridge)[1], i, j) for i in range(k) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((sides[i], sides[j]))) for _, i, j in ranked[:pairs]]
    for _ in range(rounds // 3):
        for i, j, table in model.pairs:
            step = rate * _pair_tree(*grid(i, j), ridge)[0]
            table += step
            odds += step[coarse[i], coarse[j]]
    return model


def fit_documents(
    docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5, held_out: int = 0, limit: int = MAX_ROWS
) -> Additive:
    """A model of a label, from at most ``limit`` labelled rows (see ``training_rows``).

    Only features of those rows come to the driver.
    """
    rows = training_rows(docs, labels, label, divisor, held_out, limit).select("doc_id", "label", "text")
    columns = ", ".join(f"{name} double" for name in FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), *(pa.array(c) for c in x.T)], ["doc_id", "label", *FEATURES]
            )

    got = rows.mapInArrow(measure, f"doc_id {dict(rows.dtypes)['doc_id']}, label int, {columns}").toArrow()
    got = got.sort_by([(c, "ascending") for c in ("doc_id", *FEATURES)])  # the fit must not depend on the order rows arrive in
    x = np.column_stack([got.column(c).to_numpy() for c in FEATURES]).astype(float)
    return fit(x, (got.column("label").to_numpy() == 1).astype(float))


def score(
    docs: DataFrame, model: Additive, threshold: float = 0.3, name: str = "score", decided: str = "predicted", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with the probability of label 1 as ``name``, and whether it reaches ``threshold`` as 0/1.

    The columns in ``keep`` stay (all, unless given); older columns of the two new names are replaced. A null
    text is scored as an empty one.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (name, decided)]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = model.score(features(batch.column("text")))
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*keep, name, decided])

    fields = [*docs.select(*keep).schema.fields, StructField(name, DoubleType()), StructField(decided, IntegerType())]
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(judge, StructType(fields))
