"""Hard negatives by an inverted multi-index.

A vector's two halves each belong to the nearest entry of a codebook of their own; a pair of codes is a cell. For an
anchor, the product of its half with a code's centre, raised by its own length times the code's radius (how far the
farthest half of that code lies from the centre), bounds the product with every half of that code; the sum of two such
bounds bounds the score of every row of a cell. A multi-sequence heap takes pairs of codes in falling order of that
sum, and an anchor's search ends where the next bound is below what it still needs: the last of its positives, or the last
negative that each window wants, or a window's floor. So results are exact, whatever the codebooks are.

An anchor first looks at its best cells only, to learn what it needs, then at all cells whose bound reaches that. Rows
lie on shelves, one or more per code of the first half, of some ``SHELF`` rows each; anchors are sent to the
shelves they need in groups of ``GROUP``, so that neither a hot cell nor the number of anchors is held by one task.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import written
from shoptrail.operators.ranking import top_per_group

LABELS, POSITIVES, NEGATIVES, FLOOR = 10, 5, 5, 80

# Codes per half; rows the codebooks are fitted on at most, the first by hash of their id; rounds of fitting.
CODES, SAMPLE, ROUNDS = 16, 20_000, 12

# Rows of a shelf and anchors of a group on average; rows an anchor looks at before it knows what it needs.
SHELF, GROUP, FIRST_LOOK = 8_192, 32_768, 2_000

# Bounds are raised by this part of the lengths, for rounding.
SLACK = 1e-9


def prepared(table: DataFrame, changed_every: int = 7) -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (whole numbers) of the rows that take part.

    Rows with a null id, label, vector or component, or a component that is not finite or so large that a score would
    not fit a long, take no part. Where ``changed_every`` divides the id the label is the next of ``LABELS``. Shorter
    vectors are filled up with zeros.
    """
    numbers = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding").dropna(subset=["vec_id", "label", "embedding"])
    most = F.floor(F.lit(2**31 - 1) / F.sqrt(F.greatest(F.size("embedding"), F.lit(1))))
    good = lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(256 * x.cast("double")) < most), F.lit(False))
    rows = rows.filter(F.forall("embedding", good))
    next_label = F.when(F.col("vec_id") % changed_every == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select("vec_id", next_label.cast("int").alias("label"), numbers.alias("vector"))


@dataclass
class Codebooks:
    """The centres of both halves, and for each code how far its farthest half lies from the centre."""

    dimensions: int
    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.dimensions // 2
        return vectors[:, :cut], vectors[:, cut:]

    def nearest(self, vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the code of every vector, and its distance from that code's centre."""
        return [_nearest(half, centres) for half, centres in zip(self.halves(vectors), self.centres)]

    def bounds(self, vector: np.ndarray) -> list[np.ndarray]:
        """For each half and code the largest product a half of that code can have with that of ``vector``."""
        out = []
        for half, centres, radii in zip(self.halves(vector[None, :]), self.centres, self.radii):
            length = float(np.linalg.norm(half))
            products = centres @ half[0]
            reach = length * radii
            out.append(np.where(radii < 0, -np.inf, products + reach + SLACK * (np.abs(products) + reach)))
        return out


def _nearest(half: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    apart = (centres * centres).sum(1)[None, :] - 2 * half @ centres.T
    code = apart.argmin(1)
    return code, np.sqrt(((half - centres[code]) ** 2).sum(1))


def _fitted(half: np.ndarray, codes: int, rng: np.random.Generator) -> np.ndarray:
    """k-means by Lloyd's rounds; a code without rows keeps its centre."""
    centres = half[np.sort(rng.choice(len(half), min(codes, len(half)), replace=False))].copy() if len(half) else half
    for _ in range(ROUNDS if len(half) else 0):
        code, _ = _nearest(half, centres)
        counts = np.bincount(code, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, code, half)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


def fit(rows: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> Codebooks:
    """Codebooks from at most ``sample`` rows of ``prepared``. Vectors count as long as the longest."""
    dimensions = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    chosen = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    vectors = _matrix(chosen.column("vector").combine_chunks(), dimensions)
    rng, cut = np.random.default_rng(1), dimensions // 2
    return Codebooks(dimensions, tuple(_fitted(half, codes, rng) for half in (vectors[:, :cut], vectors[:, cut:])))


def _matrix(lists: pa.Array, dimensions: int) -> np.ndarray:
    """Lists of numbers as rows of floats, zeros after the shorter ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dimensions))
    out[np.arange(dimensions)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


INDEX = "vec_id bigint, label int, vector binary, first int, second int, first_radius double, second_radius double"


def indexed(rows: DataFrame, books: Codebooks) -> DataFrame:
    """Every row with its two codes and its halves' distances from their centres; vectors as 32-bit numbers."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), books.dimensions)
            (first, near), (second, close) = books.nearest(vectors)
            data = pa.array([row.tobytes() for row in vectors.astype(np.int32)], pa.binary())
            arrays = [batch.column("vec_id"), batch.column("label"), data, pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(near), pa.array(close)], [c.split()[0] for c in INDEX.split(", ")])

    return rows.mapInArrow(assign, INDEX)


def _vectors(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), dimensions)


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs of codes, by falling sum of their bounds: the multi-sequence walk over two sorted lists."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap, seen = [(-(first[one[0]] + second[two[0]]), 0, 0)], {(0, 0)}
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(one[i]), int(two[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(one) and y < len(two) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(first[one[x]] + second[two[y]]), x, y))


@dataclass
class Index:
    """The written rows with ``shelf``, and what the driver knows: a number per code or cell."""

    books: Codebooks
    rows: DataFrame
    cell_sizes: np.ndarray
    shelves: np.ndarray  # of each first code


def stored_index(rows: DataFrame, books: Codebooks, shelf: int = SHELF) -> Index:
    """All rows under their codes, written, with the radii of the codes."""
    coded = written(indexed(rows, books), "codes")
    sizes = [len(c) for c in books.centres]
    cells = np.zeros(sizes, np.int64)
    radii = np.full(sizes[0], -1.0), np.full(sizes[1], -1.0)
    grouped = coded.groupBy("first", "second").agg(F.count("*").alias("n"), F.max("first_radius").alias("one"), F.max("second_radius").alias("two"))
    for cell in grouped.collect():  # at most a row per pair of codes
        cells[cell["first"], cell["second"]] = cell["n"]
        radii[0][cell["first"]] = max(radii[0][cell["first"]], cell["one"])
        radii[1][cell["second"]] = max(radii[1][cell["second"]], cell["two"])
    shelves = np.maximum(1, -(-cells.sum(1) // shelf))
    count = F.element_at(F.array(*(F.lit(int(n)) for n in shelves)), F.col("first") + 1) if len(shelves) else F.lit(1)
    placed = coded.select("vec_id", "label", "vector", "first", "second", F.pmod(F.xxhash64("vec_id", "vector"), count).cast("int").alias("shelf"))
    return Index(Codebooks(books.dimensions, books.centres, radii), placed, cells, shelves)


REQUEST = "vec_id bigint, label int, vector binary, windows array<bigint>, cells array<int>, first int, shelf int, part int"


def _requests(anchors: DataFrame, index: Index, groups: int, look: int | None) -> DataFrame:
    """A row per anchor and shelf it has to see, with the cells (second codes) it wants there.

    ``anchors``: ``vec_id``, ``label``, ``vector``, ``windows`` (scores of its positives), ``need`` (the least score that still matters;
    null: none is known), ``seen`` (cells looked at before). With ``look`` an anchor stops after so many rows.
    """
    books, sizes, shelves = index.books, index.cell_sizes, index.shelves
    width = sizes.shape[1]

    def wanted(vector: np.ndarray, need: float | None, seen: list[int] | None) -> Iterator[tuple[int, int]]:
        known, rows = set(seen or ()), 0
        for bound, first, second in cells_by_bound(*books.bounds(vector)):
            if (need is not None and bound < need) or (look is not None and rows >= look):
                return
            if sizes[first, second] and first * width + second not in known:
                rows += int(sizes[first, second])
                yield first, second

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in REQUEST.split(", ")]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            for piece in range(0, batch.num_rows, 256):  # bounds the copies of a vector that are held at once
                out = []
                for row in batch.slice(piece, 256).to_pylist():
                    by_first: dict[int, list[int]] = {}
                    vector = np.frombuffer(row["vector"], np.int32).astype(float)
                    for first, second in wanted(vector, row["need"], row["seen"]):
                        by_first.setdefault(first, []).append(second)
                    for first, cells in by_first.items():
                        for shelf in range(shelves[first]):
                            out.append((row["vec_id"], row["label"], row["vector"], row["windows"], cells, first, shelf, row["part"]))
                columns = list(zip(*out)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    part = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("part")
    return anchors.select("vec_id", "label", "vector", "windows", "need", "seen", part).mapInArrow(run, REQUEST)


FOUND = "anchor_id bigint, window int, score bigint, vec_id bigint"


def _scores(anchor: np.ndarray, rows: np.ndarray, exact_in_floats: bool) -> np.ndarray:
    if exact_in_floats:
        return (rows @ anchor).astype(np.int64)
    return rows.astype(np.int64) @ anchor.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` places by falling score, then by id."""
    if len(scores) > 4 * count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:count]]
    return np.lexsort((ids, -scores))[:count]


def _found(requests: DataFrame, index: Index, groups: int, negatives: bool, count: int, floor: int) -> DataFrame:
    """What the requested cells hold, the first ``count`` of each anchor, window and shelf.

    Positives: rows of the anchor's label, ``window`` 0. Negatives: rows of other labels, for each of the anchor's
    windows those from ``floor`` percent of its score to all of it.
    """
    dimensions = index.books.dimensions

    def look(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        ids, labels, seconds = (theirs.column(c).to_numpy() for c in ("vec_id", "label", "second"))
        order = np.argsort(seconds, kind="stable")
        ids, labels, seconds = ids[order], labels[order], seconds[order]
        rows = _vectors(theirs.column("vector").combine_chunks(), dimensions)[order].astype(float) if len(order) else np.zeros((0, dimensions))
        largest = float(np.abs(rows).max(initial=0))
        for row in ours.to_batches(max_chunksize=1024):
            for vec_id, label, data, windows, cells in zip(*(row.column(c).to_pylist() for c in ("vec_id", "label", "vector", "windows", "cells"))):
                cells = np.sort(np.array(cells, np.int64))
                spans = zip(np.searchsorted(seconds, cells, "left"), np.searchsorted(seconds, cells, "right"))
                at = np.concatenate([np.arange(a, b) for a, b in spans])
                at = at[(labels[at] != label) if negatives else (labels[at] == label) & (ids[at] != vec_id)]
                if not len(at):
                    continue
                vector = np.frombuffer(data, np.int32).astype(float)
                exact = largest * float(np.abs(vector).max(initial=0)) * max(dimensions, 1) < 2**53
                scores, own = _scores(vector, rows[at], exact), ids[at]
                if not negatives:
                    out += [(vec_id, 0, int(scores[i]), int(own[i])) for i in _best(scores, own, count)]
                    continue
                for window, positive in enumerate(windows):
                    fits = np.flatnonzero((scores <= positive) & (scores >= -(-floor * positive // 100)))
                    best = fits[_best(scores[fits], own[fits], count)]
                    out += [(vec_id, window, int(scores[i]), int(own[i])) for i in best]
        columns = list(zip(*out)) or [[]] * 4
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in FOUND.split(", ")])

    # A shelf is there once for each group of anchors.
    shelves = index.rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    keys = ["first", "shelf", "part"]
    return requests.groupBy(*keys).cogroup(shelves.groupBy(*keys)).applyInArrow(look, FOUND)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of each anchor and window, with ``rank``."""
    return top_per_group(found, ["anchor_id", "window"], [F.desc("score"), F.asc("vec_id")], count)


def _seen(requests: DataFrame, width: int) -> DataFrame:
    """The cells each anchor has asked for."""
    cells = F.transform("cells", lambda c: F.col("first") * width + c)
    once = requests.filter("shelf = 0").groupBy(F.col("vec_id").alias("anchor_id"))
    return once.agg(F.flatten(F.collect_list(cells)).alias("seen"))


def _searched(anchors: DataFrame, index: Index, groups: int, need: Column, negatives: bool, count: int, floor: int) -> DataFrame:
    """The first ``count`` rows of each anchor and window, certain to be all: a first look, then every cell whose bound
    reaches ``need``, an expression over ``windows`` and ``found`` (the scores of each window so far)."""
    asked = written(_requests(anchors.withColumn("seen", F.lit(None).cast("array<int>")), index, groups, FIRST_LOOK), "asked")
    first = written(_first(_found(asked, index, groups, negatives, count, floor), count).drop("rank"), "first-look")
    per_window = first.groupBy("anchor_id", "window").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    known = per_window.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", F.struct("n", "least")))).alias("found"))
    again = anchors.drop("need").join(_seen(asked, index.cell_sizes.shape[1]).withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
    again = again.join(known.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").withColumn("need", need.cast("double"))
    more = written(_requests(again, index, groups, None), "asked")
    return written(_first(first.unionByName(_found(more, index, groups, negatives, count, floor)), count), "found")


def hard_negatives(
    rows: DataFrame, books: Codebooks | None = None, anchor_every: int = 100, positives: int = POSITIVES,
    negatives: int = NEGATIVES, floor: int = FLOOR, shelf: int = SHELF,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``, from rows of ``prepared``.

    Anchors are the rows whose id ``anchor_every`` divides; of those with one id the least counts, other repeated rows
    each count. Rows of an anchor's own id are no partners of it. Scores are inner products, higher first, ties by id. For each of
    an anchor's first ``positives`` rows of its label, the first ``negatives`` rows of other labels that score from
    ``floor`` percent to all of the positive's score. A positive with none has no row.
    """
    rows = written(rows, "vectors")
    index = stored_index(rows, books or fit(rows), shelf)
    own = index.rows.filter(F.col("vec_id") % anchor_every == 0).groupBy("vec_id")
    own = own.agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")
    own = written(own.select("*", F.lit(None).cast("array<bigint>").alias("windows"), F.lit(None).cast("double").alias("need")), "anchors")
    groups = max(1, -(-own.count() // GROUP))
    if not index.cell_sizes.size:
        own = own.limit(0)

    so_far = F.element_at(F.col("found"), F.lit(0))
    last_positive = F.when(so_far["n"] >= positives, so_far["least"])
    nearest = _searched(own, index, groups, last_positive, False, positives, floor)
    windows = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    open_ = nearest.groupBy("anchor_id").agg(windows.alias("windows"))
    own = written(own.drop("windows", "need").join(open_.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "anchors")

    lowest = lambda positive: positive.cast("double") * (floor / 100)

    # The least score a window can still take: its last one if it is full, else its floor; nothing for one below 0.
    def least(positive: Column, window: Column) -> Column:
        found = F.element_at(F.coalesce("found", F.create_map().cast("map<int,struct<n:bigint,least:bigint>>")), window)
        full = F.when(found["n"] >= negatives, found["least"].cast("double"))
        return F.when(positive < 0, F.lit(float("inf"))).otherwise(F.coalesce(full, lowest(positive)))

    need = F.array_min(F.transform("windows", least))
    nothing_found = F.transform("windows", lambda p: F.when(p < 0, F.lit(float("inf"))).otherwise(lowest(p)))
    start = own.withColumn("need", F.array_min(nothing_found))
    mined = _searched(start, index, groups, need, True, negatives, floor)
    pairs = mined.select("anchor_id", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    chosen = nearest.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(chosen, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
