"""A Merkle manifest of a dataset, and the climb that checks its leaves.

Every row is a leaf, a hash of its fields. The leaves of a source in order of id are hashed in runs of ``FAN_OUT``, runs
of those again, until one node is left, the source's root; the roots of the sources in order of name make the dataset's
root in the same way. Each level that is built is stored as rows that name their parent. A recursive query then
ascends from the leaves: at every step it joins the parent's row, appends the siblings to the proof and folds the
changed leaf into the parent's hash. Leaves travel in their lowest run, so what they share is appended once.

No source is ordered in one task: rows are sorted by ranges of source and id and numbered over all sources. At the
upper levels many rows climb to the same node; a node stands there once per ``CHUNK`` leaves below it, so a key of the
join has at most so many rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptrail.llm.common import lower_ascii, written

FAN_OUT, CHUNK = 16, 65_536
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Levels of the tree over the sources are numbered from here.
TOP = 100


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``leaf``, ``changed``: the hash of each row, and that of its tampered form.

    Where 5 divides the id's crc32 the text's A-Z are lower-cased; other rows, and those without id, stay.
    """
    own = [field(F.col(c)) for c in FIELDS]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    changed = F.when(tampered, digest(*own[:-1], field(lower_ascii(F.col("text")))))
    rows = docs.select("doc_id", "source", digest(*own).alias("leaf"), changed.alias("changed"))
    return rows.withColumn("changed", F.coalesce("changed", "leaf"))


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``number``, their place from 0 in the order given, without one task for all.

    Rows are sorted by ranges (equal ones are spread by a random number), written, and their places in each range
    raised by the sizes of the ranges before; there are as many of these as shuffle partitions.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.withColumn("spread", F.rand(7)).repartitionByRange(n, *order, "spread").sortWithinPartitions(*order)
    placed = written(ranged.drop("spread").withColumn("at", F.monotonically_increasing_id()), "in-order")
    piece = F.shiftright("at", 33)
    sizes = placed.groupBy(piece.alias("piece")).agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("piece", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    joined = placed.join(F.broadcast(sizes), piece == F.col("piece"))
    number = F.col("at") - F.shiftleft("piece", 33) + F.col("earlier")
    return joined.withColumn("number", number).drop("earlier", "at")  # "piece" stays


def _run_of(place: Column) -> Column:
    return F.floor(place / FAN_OUT).cast("bigint")


def _levels_above(nodes: DataFrame, columns: list[str]) -> list[DataFrame]:
    """The levels above ``nodes``, each written: until every tree has one node.

    ``nodes``: ``tree``, ``level``, ``place`` and ``n`` (nodes) in the tree's level, ``hash``, ``low``, ``high`` (numbers of the first
    and last leaf below). A level's rows are the same with ``children``, the hashes of their runs.
    """
    levels = []
    while True:
        kin = F.array_sort(F.collect_list(F.struct("place", "hash")))
        below = nodes.filter("n > 1").withColumn("run", _run_of(F.col("place")))
        runs = below.groupBy("tree", "level", "n", "run").agg(
            F.transform(kin, lambda x: x["hash"]).alias("children"), F.min("low").alias("low"), F.max("high").alias("high")
        )
        runs = runs.withColumn("hash", F.sha2(F.array_join("children", ""), 256)).withColumn("level", F.col("level") + 1)
        runs = runs.withColumn("n", F.ceil(F.col("n") / FAN_OUT).cast("bigint")).withColumnRenamed("run", "place")
        nodes = written(runs.select(*columns, "children"), "level")
        if nodes.isEmpty():
            return levels
        levels.append(nodes)


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


NODE = ["tree", "level", "place", "n", "hash", "low", "high"]


def stored_tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree over ``leaves``: the lowest runs with their leaves, and the nodes above them.

    Both have ``hash``, ``low`` and ``high`` (numbers of their first and last leaf), ``subroot`` (it is a source's root), and their
    parent: its ``up_level`` and ``up_key``, and their ``position`` among its children; the root has none. Nodes are known by
    ``level`` and ``key`` and have ``children``, hashes in order. Runs have ``members``: ``place``, ``leaf``, ``changed``,
    ``doc_id``; a source's only leaf is a run by itself, and its own hash.
    """
    by_source = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    ordered = numbered(written(rows, "leaves"), *by_source)
    # A source's first number and size, for each range it stands in.
    parts = written(ordered.groupBy("source", "piece").agg(F.min("number").alias("low"), F.count("*").alias("n")), "parts")
    own = Window.partitionBy("source")
    trees = parts.select("source", "piece", F.min("low").over(own).alias("tree"), F.sum("n").over(own).alias("n"))
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.piece") == F.col("b.piece"))
    ordered = ordered.alias("a").join(trees.alias("b"), same).select("a.*", "b.tree", "b.n")
    member = F.struct((F.col("number") - F.col("tree")).alias("place"), "leaf", "changed", "doc_id")
    runs = ordered.groupBy("tree", "n", _run_of(F.col("number") - F.col("tree")).alias("place")).agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.min("number").alias("low"), F.max("number").alias("high")
    )
    leaf_hashes = F.transform("members", lambda m: m["leaf"])
    runs = runs.withColumn("hash", F.when(F.col("n") == 1, leaf_hashes[0]).otherwise(F.sha2(F.array_join(leaf_hashes, ""), 256)))
    runs = runs.withColumn("level", F.when(F.col("n") == 1, 0).otherwise(1))
    runs = written(runs.withColumn("n", F.ceil(F.col("n") / FAN_OUT).cast("bigint")), "runs")

    inner = _levels_above(runs.select(*NODE), NODE)
    roots = _all([level.select("tree", "hash", "low", "high").filter("n = 1") for level in (runs, *inner)])
    sources = numbered(written(roots, "roots"), F.col("tree").asc()).drop("piece")
    sources = sources.withColumn("n", F.lit(roots.count()).cast("bigint"))
    top = sources.select(
        F.lit(-1).cast("bigint").alias("tree"), F.lit(TOP).alias("level"), F.col("number").alias("place"), "n", "hash", "low", "high"
    )
    upper = _levels_above(written(top, "sources"), NODE)

    # Of a tree's nodes all places follow from the tree's first leaf; those over the sources go by their place.
    in_tree = F.col("tree") + _run_of(F.col("place")) * F.pow(F.lit(FAN_OUT), F.col("level") + 1).cast("bigint")
    position = (F.col("place") % FAN_OUT).cast("int").alias("position")
    of_source = F.when(F.col("s_n") > 1, F.lit(TOP + 1)).alias("up_level"), _run_of(F.col("number")).alias("up_key")
    numbers = sources.select("tree", "number", F.col("n").alias("s_n"))

    def with_parent(nodes: DataFrame) -> DataFrame:
        below = nodes.filter("n > 1").select("*", (F.col("level") + 1).alias("up_level"), in_tree.alias("up_key"), position, F.lit(False).alias("subroot"))
        root = nodes.filter("n = 1").join(numbers, "tree").withColumn("subroot", F.lit(True))
        root = root.select(*nodes.columns, *of_source, (F.col("number") % FAN_OUT).cast("int").alias("position"), "subroot")
        return below.unionByName(root)

    nodes = [with_parent(level).withColumn("key", F.col("low")) for level in inner]
    for level in upper:
        parent = F.when(F.col("n") > 1, F.col("level") + 1).alias("up_level"), _run_of(F.col("place")).alias("up_key")
        nodes.append(level.select("*", *parent, position, F.lit(False).alias("subroot"), F.col("place").alias("key")))
    columns = ["level", "key", "low", "high", "hash", "children", "up_level", "up_key", "position", "subroot"]
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "level int, key bigint, low bigint, high bigint, hash string, children array<string>, up_level int, up_key bigint, position int, subroot boolean")
    stored = written(_all([empty, *(level.select(*columns) for level in nodes)]), "nodes")
    return written(with_parent(runs).drop("tree", "level", "place", "n"), "runs"), stored


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT low, up_level, up_key, position, folded, '' AS proof, IF(subroot, hash, CAST(NULL AS STRING)) AS subroot, hash FROM {runs}
  UNION ALL
  SELECT c.low, n.up_level, n.up_key, n.position,
    transform(c.folded, f -> sha2(array_join(transform(n.children, (h, i) -> IF(i = c.position, f, h)), ''), 256)),
    concat(c.proof, array_join(filter(n.children, (h, i) -> i <> c.position), '')),
    coalesce(c.subroot, IF(n.subroot, n.hash, CAST(NULL AS STRING))), n.hash
  FROM climb c JOIN {nodes} n ON n.level = c.up_level AND n.key = c.up_key AND n.chunk = c.low DIV {chunk})
SELECT low, folded, proof, subroot, hash AS root FROM climb WHERE up_level IS NULL LIMIT ALL"""


def climbed(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``low``, ``folded``, ``proof``, ``subroot``, ``root`` of each lowest run, by a recursive query.

    ``folded`` has, for each member, the root that follows from its changed leaf and the original siblings;
    ``proof`` are the siblings above the run.
    """
    changed = lambda m: F.transform("members", lambda x: F.when(x["place"] == m["place"], m["changed"]).otherwise(x["leaf"]))
    alone = F.size("members") == 1
    fold = lambda m: F.when(alone & F.col("subroot"), m["changed"]).otherwise(F.sha2(F.array_join(changed(m), ""), 256))
    start = runs.select("low", "hash", "up_level", "up_key", "position", "subroot", F.transform("members", fold).alias("folded"))
    chunks = F.sequence(F.floor(F.col("low") / CHUNK), F.floor(F.col("high") / CHUNK))
    copies = nodes.withColumn("chunk", F.explode(chunks))
    return runs.sparkSession.sql(CLIMB, runs=start, nodes=copies, chunk=CHUNK)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified`` for each row of ``docs``.

    Columns of ``FIELDS`` are hashed. Null ids come first in their source; rows of equal id go by their hash, so equal rows may
    stand in any order. An empty table gives no rows.
    """
    runs, nodes = stored_tree(leaves(docs))
    climb = written(climbed(runs, nodes), "climbed")
    found = runs.select("low", "members").join(climb, "low")
    member = found.select("members", "proof", "subroot", "root", "folded", F.posexplode("members").alias("i", "m"))
    others = F.array_join(F.transform(F.filter("members", lambda m: m["place"] != F.col("m.place")), lambda m: m["leaf"]), "")
    folded = F.get("folded", F.col("i"))
    return member.select(
        "m.doc_id", "m.leaf", "subroot", "root", digest(others, F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )
