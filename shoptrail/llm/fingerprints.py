"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a piece wherever it meets a trigger, about every ``block`` bytes; each piece gives
one character. The block size doubles with the text's length from ``LEAST_BLOCK``, so that signatures have some
dozens of characters, and a fingerprint holds the signatures of its block size and of twice that. Fingerprints
of block sizes at most a factor of two apart are compared by edit distance where both have a signature.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import mix, slices, written

LEAST_BLOCK, PIECES, ROLLED, COMMON_RUN = 4, 48, 7, 6
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)

_ODD = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as a text was long."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k, inverse = len(self.up), pow(_ODD, -1, 2**64)
            self.up = np.concatenate((self.up, self.up * np.uint64(pow(_ODD, k, 2**64))))
            self.down = np.concatenate((self.down, self.down * np.uint64(pow(inverse, k, 2**64))))


def block_size(n: int) -> int:
    """The smallest doubling of the least block size that cuts ``n`` bytes into at most ``PIECES`` pieces on average."""
    block = LEAST_BLOCK
    while block * PIECES < n:
        block *= 2
    return block


def fingerprint(data: bytes, powers: Powers) -> str:
    """``block:signature:signature at twice the block``. Depends on the bytes alone; empty text is ``4::``."""
    n = len(data)
    block = block_size(n)
    if not n:
        return f"{block}::"
    powers.reach(n + 1)
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    # Sums of value * power; the difference of two, brought back to power 0, is a piece's hash.
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers.up[:n], dtype=np.uint64)))
    ends = np.arange(1, n + 1)
    starts = np.maximum(ends - ROLLED, 0)
    rolling = mix((sums[ends] - sums[starts]) * powers.down[starts])
    out = [str(block)]
    for size in (block, 2 * block):
        cuts = np.flatnonzero(rolling % np.uint64(size) == size - 1) + 1
        cuts = np.concatenate(([0], cuts, [n])) if not len(cuts) or cuts[-1] != n else np.concatenate(([0], cuts))
        pieces = mix((sums[cuts[1:]] - sums[cuts[:-1]]) * powers.down[cuts[:-1]] + (cuts[1:] - cuts[:-1]).astype(np.uint64))
        out.append(ALPHABET[(pieces >> np.uint64(58)).astype(np.int64)].tobytes().decode())
    return ":".join(out)


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with whole numbers as bit vectors."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    all_ones = (1 << len(a)) - 1
    v = all_ones
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & all_ones
    return len(a) - v.bit_count()


def _signature_likeness(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (both lengths); 0 without a common run, which chance rarely gives. The run is
    ``COMMON_RUN`` long, or a third of the shorter signature."""
    if a == b:
        return 1.0
    run = min(COMMON_RUN, max(1, min(len(a), len(b)) // 3))
    if not a or not b or {a[i : i + run] for i in range(len(a) - run + 1)}.isdisjoint(b[i : i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common_length(a, b) / (len(a) + len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 for block sizes more than a factor of two apart."""
    if one == other:
        return 1.0
    (a, a1, a2), (b, b1, b2) = one.split(":"), other.split(":")
    a, b = int(a), int(b)
    if a == b:
        return max(_signature_likeness(a1, b1), _signature_likeness(a2, b2))
    if a == 2 * b:
        return _signature_likeness(a1, b2)
    if b == 2 * a:
        return _signature_likeness(a2, b1)
    return 0.0


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` (null: of empty text) as column ``name``; an older one is replaced."""
    kept = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in slices(batches, text):
            found = [fingerprint((x or "").encode(), powers) for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name])

    return kept.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in [*kept.dtypes, (name, "string")]))


_PAIR = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(doc_id, text: str, own: str, following: str, next_print: str, powers: Powers) -> tuple:
    """The result for a text and the next one: the edited text has the first as many characters of the next."""
    from hashlib import sha256

    cut = len(text) // 3
    edited = (text[: len(text) - cut] + following[:cut]).encode()
    edited_print = fingerprint(edited, powers)
    return (
        doc_id, len(text), sha256(edited).hexdigest(), own, edited_print, likeness(own, edited_print), likeness(own, next_print),
    )


def against_next(docs: DataFrame) -> DataFrame:
    """Every document (``doc_id``, ``text``; null: empty) against its edited text and the next document.

    Next is by falling ``doc_id``, null last, after the last the first; rows of equal id go by their text's hash. The
    edited text has the last third of the characters replaced by the first as many (or all) of the next
    document. Texts are shuffled once, by ranges of id and hash, equal rows dealt at random, and each range is read in
    order; where two ranges meet, the two documents are compared in a small second step.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"place": F.xxhash64("text"), "spread": F.rand(7)})
    order = [F.col("doc_id").desc_nulls_last(), F.col("place").asc(), F.col("spread").asc()]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "text", F.spark_partition_id().alias("range"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, before, edges, number = Powers(), None, [], None
        names = [c.split()[0] for c in _PAIR.split(", ")]
        for batch in slices(batches):
            out, number = [], batch.column("range")[0].as_py()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = fingerprint(text.encode(), powers)
                if before is None:
                    edges.append((doc_id, text, True))
                else:
                    out.append(_compared(*before, text, own, powers))
                before = (doc_id, text, own)
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield _with_edges(columns, names, [], number)
        if before is not None:
            edges.append((before[0], before[1], False))
            yield _with_edges([[]] * len(names), names, edges, number)

    found = written(ranged.mapInArrow(run, f"{_PAIR}, text string, first boolean, range int"), "fingerprints")
    # A range's last document is followed by the first one of the next range that has any, after all by the very first.
    edges = found.filter("first is not null").select("doc_id", "text", "first", "range")
    in_order = Window.orderBy("range")  # over the numbers of ranges only
    ranges = edges.filter("first").select("range")
    top = F.first("range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranges = ranges.select("range", F.coalesce(F.lead("range").over(in_order), top).alias("next"))
    following = edges.filter("first").select(F.col("range").alias("next"), F.col("text").alias("following"))
    met = edges.filter("not first").join(ranges, "range").join(following, "next")

    def join_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, names = Powers(), [c.split()[0] for c in _PAIR.split(", ")]
        for batch in batches:
            out = []
            for doc_id, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
                prints = [fingerprint(x.encode(), powers) for x in (text, following)]
                out.append(_compared(doc_id, text, prints[0], following, prints[1], powers))
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names)

    inside = found.filter("first is null").select(*(c.split()[0] for c in _PAIR.split(", ")))
    return inside.unionByName(met.select("doc_id", "text", "following").mapInArrow(join_ranges, _PAIR))


_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]


def _with_edges(columns: list, names: list[str], edges: list[tuple], number: int | None) -> pa.RecordBatch:
    """Results, then edge rows (id, text, whether it is the first of its range), which have nothing but these and the
    range's number."""
    n = len(columns[0])
    arrays = [pa.array([*c, *[None] * len(edges)], t) for c, t in zip(columns, _TYPES)]
    arrays[0] = pa.array([*columns[0], *(e[0] for e in edges)], pa.int64())
    text, first = pa.array([*[None] * n, *(e[1] for e in edges)], pa.string()), pa.array([*[None] * n, *(e[2] for e in edges)], pa.bool_())
    ranges = pa.array([*[None] * n, *[number] * len(edges)], pa.int32())
    return pa.RecordBatch.from_arrays([*arrays, text, first, ranges], [*names, "text", "first", "range"])
