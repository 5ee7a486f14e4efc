"""MinHash near-duplicates with tensored banding.

Two collections of ``n`` short keys are made per text, each key from ``k`` minhashes. A table key
pairs a key of the first collection with one of the second, so ``2*n*k`` minhashes serve ``n*n``
tables of ``2*k`` minhashes. Texts that meet in a table are candidates; their full shingle sets
decide. With the defaults (n = 10, k = 2) a pair at similarity 0.8 is missed with a chance of
2 * (1 - 0.8**2)**10 = 0.00007, one at 0.9 with 2e-7.

A table's texts are not all compared. First each text is compared with one centre of its key (twice, with
two centres), which joins large groups of copies at a cost in proportion to the rows. Keys whose texts are then
of one class are finished. In the others, texts of different classes are compared by a sketch of ``BITS`` bits, one
per further minhash, in blocks of ``BLOCK`` texts, so that a hot key is shared out among many tasks; a
pair is compared exactly if the sketch estimates a similarity of at least ``SURE`` below the limit, which a true
pair misses with a chance of 0.0001, and only in the first table it meets in.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import mix, slices, split_words, word_hashes, written

SHINGLE, PERCENT = 5, 80
TABLE_SIDE, KEY_HASHES = 10, 2
STAR_ROUNDS = 2
BITS, SURE, BLOCK = 2048, 0.05, 2048

# Room for TABLE_SIDE * TABLE_SIDE numbers in a key, and the ids broadcast at most (8 bytes each).
TABLE_BITS, BROADCAST_IDS = 7, 1_000_000

SKETCH = "doc_id bigint, n_shingles bigint, set_id string, first array<bigint>, second array<bigint>"


def shingle_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text, ascending, and where each text's start and end.

    A text of fewer words than a shingle has one, its whole sequence; one without words has none.
    """
    words, at = split_words(texts)
    hashes = word_hashes(words)
    n_words = at[1:] - at[:-1]
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for j in range(shingle):  # by position in the shingle; what runs over a text's end is left out below
        rolled[: n - j] = mix(rolled[: n - j] * np.uint64(0x9E3779B97F4A7C15) + hashes[j:] + np.uint64(j + 1))
    owner = np.repeat(np.arange(len(n_words)), n_words)
    place = np.arange(n) - at[:-1][owner]
    whole = place + shingle <= n_words[owner]
    short = (n_words > 0) & (n_words < shingle)
    for i in np.flatnonzero(short):
        value = np.zeros(1, np.uint64)
        for j, word in enumerate(hashes[at[i] : at[i + 1]]):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(j + 1))
        rolled[at[i]], whole[at[i]] = value[0], True
    rolled, owner = rolled[whole], owner[whole]
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    rolled, owner = rolled[new], owner[new]
    return rolled, np.searchsorted(owner, np.arange(len(n_words) + 1))


def _least(sets: np.ndarray, starts: np.ndarray, number: int) -> np.ndarray:
    """The minhash of that number of each set; sets begin at ``starts`` and have members."""
    salt = mix(np.array([number + 1], np.uint64) * np.uint64(0xD1342543DE82EF95))
    # A multiplication by an odd number and a shift keep order random enough for a minimum.
    values = (sets ^ salt) * (salt | np.uint64(1))
    values ^= values >> np.uint64(29)
    return np.minimum.reduceat(values, starts) if len(starts) else values[:0]


def _keys(sets: np.ndarray, at: np.ndarray, side: int, width: int) -> np.ndarray:
    """The ``2*side`` short keys of each set that has members: one row each."""
    starts = at[:-1][at[1:] > at[:-1]]
    keys = np.zeros((len(starts), 2 * side), np.uint64)
    for i in range(2 * side):
        for j in range(width):
            keys[:, i] = mix(keys[:, i] + _least(sets, starts, i * width + j) + np.uint64(j))
    return keys


def sketches(docs: DataFrame, shingle: int = SHINGLE, side: int = TABLE_SIDE, width: int = KEY_HASHES) -> DataFrame:
    """Per row: the set's size, an identity of the whole set, and the two collections of short keys.

    Null and empty texts, and texts of blanks, have size 0 and no keys.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, at = shingle_sets(batch.column("text"), shingle)
            sizes, full = at[1:] - at[:-1], np.flatnonzero(at[1:] > at[:-1])
            keys = np.zeros((len(sizes), 2 * side), np.int64)
            keys[full] = _keys(sets, at, side, width).view(np.int64)
            names = np.full(len(sizes), None, object)
            if len(full):
                one, two = (np.add.reduceat(mix(sets + np.uint64(x)), at[:-1][full]) for x in (1, 2))
                names[full] = [f"{a:x}-{b:x}-{c}" for a, b, c in zip(one.tolist(), two.tolist(), sizes[full].tolist())]
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * side)
            halves = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(h).ravel())) for h in (keys[:, :side], keys[:, side:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(names, pa.string()), *halves],
                ["doc_id", "n_shingles", "set_id", "first", "second"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(sketch, SKETCH)


def _meetings(sketched: DataFrame) -> DataFrame:
    """``key``, ``doc_id``, ``size``: a row per table in which a text meets another one.

    The lowest ``TABLE_BITS`` bits of a key are the table's number; what is shuffled is key and id alone.
    """
    side = F.size("first")
    rows = (
        sketched.select("doc_id", "second", side.alias("side"), F.posexplode("first").alias("i", "a"))
        .select("doc_id", "side", "i", "a", F.posexplode("second").alias("j", "b"))
        .select(F.shiftleft(F.xxhash64("a", "b"), TABLE_BITS).bitwiseOR(F.col("i") * F.col("side") + F.col("j")).alias("key"), "doc_id")
    )
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    sizes = sketched.select("doc_id", F.col("n_shingles").alias("size"))
    return rows.join(shared, "key").join(sizes, "doc_id")


def _those_of(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``table`` with one of the distinct ``ids``, a written table. A list of bounded size is broadcast, so
    that texts are not shuffled to find a few; for a longer one both sides are."""
    few = ids.count() <= BROADCAST_IDS
    return table.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def stored_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``doc_id``, ``shingles`` (hashes of the full set) of some documents, written."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, at = shingle_sets(batch.column("text"), shingle)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "shingles"])

    texts = _those_of(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), ids)
    return written(texts.mapInArrow(sets_of, "doc_id bigint, shingles array<bigint>"), "shingle-sets")


def confirmed(pairs: DataFrame, stored: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets have 100 * intersection >= percent * union."""
    left, right = (
        _those_of(stored, written(pairs.select(F.col(c).alias("doc_id")).distinct(), "pair-ids")).select(
            F.col("doc_id").alias(c), F.col("shingles").alias(f"{c}_set")
        )
        for c in "ab"
    )
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``doc_id`` and ``component``, the smallest id reachable, for every id that has an edge (``a``, ``b``).

    Alternates large-star and small-star steps until nothing changes; each step hangs neighbours on the
    smallest one by a join on the node, and is written to the shared folder.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    pairs, before = written(pairs, "stars"), None
    while True:
        around = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        pairs = written(small.filter("u != v").distinct(), "stars")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            return pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("doc_id"), F.col("m").alias("component")).union(
                pairs.select("v", "v").distinct().toDF("doc_id", "component")
            )
        before = tuple(state)


def _alike_in_size(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _star_pairs(rows: DataFrame, round_: int, percent: int) -> DataFrame:
    """Every text of a key with the key's centre, if their classes differ: the least id, then the least by hash."""
    order = F.col("doc_id") if round_ == 0 else F.xxhash64("doc_id", F.lit(round_))
    centre = F.min(F.struct(order.alias("order"), "doc_id", "size", "label")).alias("c")
    centres = rows.groupBy("key").agg(centre).select("key", *(F.col(f"c.{x}").alias(f"c_{x}") for x in ("doc_id", "size", "label")))
    met = rows.join(centres, "key").filter("label != c_label").filter(_alike_in_size("size", "c_size", percent))
    return met.select(F.least("doc_id", "c_doc_id").alias("a"), F.greatest("doc_id", "c_doc_id").alias("b")).distinct()


def _open_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of keys whose texts are of several classes (``label``), by the components found so far."""
    rows = rows.drop("label", "n").join(found, "doc_id", "left")
    rows = rows.withColumn("label", F.coalesce("component", "doc_id")).drop("component")
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    return rows.join(mixed.filter("low != high").select("key", "n"), "key")


def _fine_sketches(stored: DataFrame, ids: DataFrame, first_hash: int) -> DataFrame:
    """``doc_id``, ``bits`` of some documents: the lowest bits of ``BITS`` further minhashes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            sets = lists.flatten().to_numpy().view(np.uint64)
            full = np.flatnonzero(at[1:] > at[:-1])
            bits = np.zeros((len(full), BITS), bool)
            for i in range(BITS):
                bits[:, i] = _least(sets, at[:-1][full], first_hash + i) & np.uint64(1)
            packed = [row.tobytes() for row in np.packbits(bits, axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(full)), pa.array(packed, pa.binary())], ["doc_id", "bits"])

    return _those_of(stored, ids).mapInArrow(sketch, "doc_id bigint, bits binary")


def _close_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different classes whose sketches are close, from the rows of open keys.

    ``rows``: ``key``, ``n`` (rows of the key), ``doc_id``, ``size``, ``label``, ``short`` (all short keys), ``bits``. A key
    of many rows is cut into blocks; a row goes to each pair of blocks that its own one is in.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    meets = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.struct(F.least(own, x).alias("p"), F.greatest(own, x).alias("q")))
    dealt = rows.select("*", own.alias("block"), F.explode(meets).alias("cell"))
    dealt = dealt.withColumn("cell", F.xxhash64("key", "cell.p", "cell.q")).drop("n")
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(count, "cell").sortWithinPartitions("cell", "doc_id")
    least = percent / 100 - SURE

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell = None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1], [True])))
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if held and cells[start] != cell:
                    yield _compared(held, least, percent)
                    held = []
                held.append(batch.slice(start, stop - start))
                cell = cells[start]
        if held:
            yield _compared(held, least, percent)

    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


def _compared(held: list[pa.RecordBatch], least: float, percent: int) -> pa.RecordBatch:
    """The close pairs of one cell, each row against the later ones."""
    table = pa.Table.from_batches(held)
    column = lambda name: table.column(name).to_numpy()
    ids, sizes, labels, blocks = (column(c) for c in ("doc_id", "size", "label", "block"))
    bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(ids), -1)
    short = np.frombuffer(b"".join(table.column("short").to_pylist()), np.uint32).reshape(len(ids), -1)
    side = short.shape[1] // 2
    first, second = short[:, :side], short[:, side:]
    i, j = divmod(int(column("key")[0]) & ((1 << TABLE_BITS) - 1), side)
    two_blocks = blocks.min() != blocks.max()
    out_a, out_b = [], []
    for x in range(len(ids) - 1):
        rest = np.arange(x + 1, len(ids))
        fits = (labels[rest] != labels[x]) & (100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x]))
        if two_blocks:  # those of one block meet in its own cell
            fits &= blocks[rest] != blocks[x]
        rest = rest[fits]
        # Only in the first table that the two share.
        rest = rest[~(first[rest, :i] == first[x, :i]).any(1) & ~(second[rest, :j] == second[x, :j]).any(1)]
        if not len(rest):
            continue
        unlike = np.bitwise_count(bits[rest] ^ bits[x]).sum(1, dtype=np.int64)
        rest = rest[1 - 2 * unlike / BITS >= least]
        out_a.append(np.minimum(ids[rest], ids[x]))
        out_b.append(np.maximum(ids[rest], ids[x]))
    join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([join(out_a), join(out_b)], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents are linked when 100 * intersection >= percent * union of their sets of word shingles;
    ``component_id`` is the smallest id reachable over links, ``kept`` marks the document of that id. Texts
    without words are linked with nothing. Rows of the same id are one node of the graph. A row without id
    is linked with nothing, has no component and is kept.
    """
    sketched = written(sketches(docs, shingle), "sketches")
    # Equal sets are one text from here on.
    groups = sketched.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id")
    same_for_all = [F.first(c).alias(c) for c in ("n_shingles", "first", "second")]
    one = groups.agg(F.min("doc_id").alias("doc_id"), *same_for_all)
    sets = written(one, "sets")
    copies = sketched.filter("set_id is not null").join(sets.select("set_id", F.col("doc_id").alias("rep")), "set_id")
    same = copies.filter("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct()
    rows = written(_meetings(sets).withColumn("label", F.col("doc_id")), "meetings")
    stored = stored_sets(docs, written(rows.select("doc_id").distinct(), "met"), shingle)
    links, found = written(same, "links"), None
    for round_ in range(STAR_ROUNDS):
        pairs = written(_star_pairs(rows, round_, percent), "pairs")
        links = written(links.union(confirmed(pairs, stored, percent)).distinct(), "links")
        found = written(components(links), "components")
        rows = written(_open_rows(rows, found), "open-keys")
    if not rows.isEmpty():
        ids = written(rows.select("doc_id").distinct(), "open-ids")
        fine = written(_fine_sketches(stored, ids, 2 * TABLE_SIDE * KEY_HASHES), "fine-sketches")
        key_bytes = lambda c, i: F.unhex(F.lpad(F.hex(F.get(c, F.lit(i))), 16, "0"))
        short = F.concat(*(F.substring(key_bytes(c, i), 5, 4) for c in ("first", "second") for i in range(TABLE_SIDE)))
        fine = fine.distinct().join(sets.select("doc_id", short.alias("short")), "doc_id")
        pairs = written(_close_pairs(rows.join(fine, "doc_id"), percent), "pairs")
        links = written(links.union(confirmed(pairs, stored, percent)).distinct(), "links")
        found = written(components(links), "components")
    joined = sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are linked to one of a smaller id; all columns stay."""
    dropped = near_duplicates(docs, shingle, percent).filter("not kept").select("doc_id").distinct()
    return docs.join(written(dropped, "dropped"), "doc_id", "left_anti").select(*docs.columns)
