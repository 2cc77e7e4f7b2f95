"""A Merkle manifest of a table, and the proofs of all its rows.

A row's leaf is the digest of its columns.  Rows of one language are a tree in the
order of their ids, and the languages' roots, in order, are the leaves of one more
tree.  Leaves are numbered by a range partitioning, and cut into *blocks* of
``2 ** BITS`` consecutive ones, a leaf partition each, so a language of any size is
worked on by many tasks.  Trees grow by blocks, too: a round makes BITS levels.

Proofs are an octopus: a leaf partition works out which nodes its leaves' paths
need and cannot derive from its own leaves, the smallest such set, fetches each of
them once, derives the nodes that its paths share, and writes out the single
proofs on the spot.  What is shuffled is one row per block and missing node, and no
proof of a single row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillwork.llm.common import saved, scratch
from rillwork.operators.ordered import lookup

#: Levels per round: a block has 2 ** BITS leaves at most.
BITS = 10
#: The uppermost nodes, which most blocks ask for, go to every executor: so many at most.
TOP_NODES = 1 << 16
#: The number of the tree over the languages' roots.
TOP_TREE = -1

#: A node's place: tree, level from the leaves, place in the level.
Place = tuple[int, int, int]


class Manifest(NamedTuple):
    """``leaves``: id, leaf, altered, tree, n, pos.  ``nodes``: tree, level, idx, digest, for levels from the blocks' roots up.

    ``wanted`` has the places that each block (tree, block) of 2 ** ``bits`` leaves is missing.
    """

    leaves: DataFrame
    nodes: DataFrame
    wanted: DataFrame
    n_trees: int
    root: str
    bits: int


def digest(*parts: bytes) -> bytes:
    """Lower-case hexadecimal SHA-256 of parts joined."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    return (n - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes of a level above ``n`` leaves."""
    return -(-n >> level)


def above(nodes: Mapping[int, bytes], n: int, level: int, upto: int) -> list[dict[int, bytes]]:
    """The given nodes of a level and those above them, by place, up to a level.

    A node without a sibling has a parent of its own; the siblings that exist must be given.
    """
    levels = [dict(nodes)]
    for _ in range(level, upto):
        below = levels[-1]
        parents = {i >> 1 for i in below}
        levels.append({i: digest(*[below[c] for c in (2 * i, 2 * i + 1) if c in below]) for i in parents})
    return levels


def missing(tree: int, n: int, positions: Iterable[int]) -> list[Place]:
    """The nodes that the paths of some leaves need and that cannot be derived from these leaves."""
    found, known = [], set(positions)
    for level in range(height(n)):
        others = {i ^ 1 for i in known} - known
        found += [(tree, level, i) for i in sorted(others) if i < width(n, level)]
        known = {i >> 1 for i in known}
    return found


def field(value: Column) -> Column:
    """A value for hashing: its length in UTF-8 bytes, a colon, the value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def numbered(leaves: DataFrame) -> DataFrame:
    """Add ``tree`` (languages in order, null first), ``n`` (its leaves) and ``pos`` (from 0, by id and leaf).

    No task holds a language: rows are sorted by range, and counts per language and
    partition say how many come before.
    """
    order = ["lang", "id", "leaf"]
    placed = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = saved(placed.withColumn("_place", F.monotonically_increasing_id()), "manifest-sorted")
    placed = placed.withColumn("_slice", F.shiftright("_place", 33))
    sizes = placed.groupBy("_slice", "lang").agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy("lang").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # Ranges: at most one row per partition and language change.
    sizes = saved(sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0))), "manifest-sizes")
    # One row per language.
    trees = sizes.groupBy("lang").agg(F.sum("_size").alias("n"))
    trees = trees.withColumn("tree", F.row_number().over(Window.orderBy(F.asc_nulls_first("lang"))).cast("bigint") - 1)
    starts = lookup(sizes, trees, ["lang"])
    rows = lookup(placed, starts, ["_slice", "lang"], to_all=True)
    pos = F.col("_before") + F.col("_place") - F.col("_first")
    return rows.withColumn("pos", pos).drop("_slice", "_place", "_size", "_first", "_before")


NODES = "tree bigint, n bigint, level int, idx bigint, digest binary"


def grown(nodes: DataFrame, level: int, bits: int) -> DataFrame:
    """The next ``bits`` levels above nodes of one level, as far as the trees are not at their roots."""

    def run(group: pa.Table) -> pa.Table:
        tree, n = group.column("tree")[0].as_py(), group.column("n")[0].as_py()
        given = dict(zip(group.column("idx").to_pylist(), group.column("digest").to_pylist()))
        levels = above(given, n, level, min(level + bits, height(n)))
        made = [(tree, n, level + k, i, d) for k, row in enumerate(levels) if k for i, d in row.items()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), KINDS)], schema=NODE_SCHEMA)

    higher = nodes.filter(F.col("n") > (1 << level)).withColumn("_part", F.shiftright("idx", bits))
    return higher.groupBy("tree", "_part").applyInArrow(run, NODES)


KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
NODE_SCHEMA = pa.schema(list(zip(["tree", "n", "level", "idx", "digest"], KINDS)))


def tree_nodes(nodes: DataFrame, level: int, most: int, bits: int) -> DataFrame:
    """All nodes from those of a level up to the roots; ``most`` leaves has the largest tree."""
    found = nodes
    while most > (1 << level):
        step = saved(grown(nodes, level, bits), "manifest-nodes")
        found = found.unionByName(step)
        level += bits
        nodes = step.filter(F.col("level") == level)
    return found


def build(
    docs: DataFrame, columns: Sequence[str], tree_col: str, id_col: str, altered: Mapping[str, Column] | None = None,
    where: Column | None = None, bits: int = BITS,
) -> Manifest:
    """Digests of all rows and of all nodes above the blocks.  Calling it runs jobs.

    ``altered`` gives other values of columns for the rows ``where``: these rows have
    a second leaf, which is no part of the tree.
    """
    real = [F.col(c) for c in columns]
    second = [(altered or {}).get(c, F.col(c)) for c in columns]
    changed = F.coalesce(where, F.lit(False)) if altered and where is not None else F.lit(False)
    leaves = docs.select(
        F.col(id_col).alias("id"), F.col(tree_col).cast("string").alias("lang"), leaf(real).alias("leaf"),
        F.when(changed, leaf(second)).alias("altered"),
    )
    leaves = saved(numbered(saved(leaves, "manifest-leaves")).drop("lang"), "manifest-numbered")
    n_trees, most = leaves.agg(F.coalesce(F.max("tree") + 1, F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()

    def block(group: pa.Table) -> pa.Table:
        """The block's root, and the places that it is missing, without a digest."""
        tree, n, pos = group.column("tree")[0].as_py(), group.column("n")[0].as_py(), group.column("pos").to_pylist()
        given = {p: d.hex().encode() for p, d in zip(pos, group.column("leaf").to_pylist())}
        level = min(bits, height(n))
        here, number = above(given, n, 0, level)[level], pos[0] >> bits
        made = [(tree, n, number, tree, level, i, d) for i, d in here.items()]
        places = missing(tree, n, pos) + missing(TOP_TREE, n_trees, [tree])
        made += [(tree, n, number, *place, None) for place in places]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        names = ["tree", "n", "block", "want", "level", "idx", "digest"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], names=names)

    blocks = leaves.select("tree", "n", "pos", "leaf", F.shiftright("pos", bits).alias("block"))
    schema = "tree bigint, n bigint, block bigint, want bigint, level int, idx bigint, digest binary"
    found = saved(blocks.groupBy("tree", "block").applyInArrow(block, schema), "manifest-blocks")
    roots = found.filter(F.col("digest").isNotNull()).select("tree", "n", "level", "idx", "digest")
    nodes = tree_nodes(roots, bits, most, bits)
    # A tree's root is its only node without a sibling at the level of its height.
    subroots = nodes.filter("idx = 0 AND shiftleft(1L, level) >= n").select(
        F.lit(TOP_TREE).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), F.lit(0).alias("level"),
        F.col("tree").alias("idx"), "digest",
    )
    top = saved(tree_nodes(saved(subroots, "manifest-subroots"), 0, n_trees, bits), "manifest-top")
    last = top.orderBy(F.desc("level")).first()
    wanted = found.filter(F.col("digest").isNull()).select("tree", "block", "want", "level", "idx")
    return Manifest(leaves, nodes.unionByName(top).drop("n"), wanted, n_trees, last.digest.decode() if last else "", bits)


def fetched(manifest: Manifest, top_nodes: int = TOP_NODES) -> DataFrame:
    """The missing nodes of each block as one list; the uppermost go to every executor, the others are joined."""
    nodes = manifest.nodes.withColumnRenamed("tree", "want")
    upper = F.col("want") == TOP_TREE
    sizes = {r[0]: r[1] for r in nodes.groupBy(F.when(~upper, F.col("level"))).count().collect()}
    room, cut = top_nodes - sizes.pop(None, 0), None
    for level in sorted(sizes, reverse=True):
        room -= sizes[level]
        if room < 0:
            break
        cut = level
    on = ["want", "level", "idx"]
    if room < 0 and cut is None:
        joined = manifest.wanted.join(nodes, on)
    else:
        high = upper | (F.col("level") >= cut) if cut is not None else upper
        joined = manifest.wanted.filter(high).join(F.broadcast(nodes.filter(high)), on)
        if room < 0:
            joined = joined.unionByName(manifest.wanted.filter(~high).join(nodes.filter(~high), on))
    place = F.struct("want", "level", "idx", "digest")
    # A block misses at most one node per level of both trees.
    return joined.groupBy("tree", "block").agg(F.collect_list(place).alias("nodes"))


def fold(node: bytes, path: Iterable[tuple[int, bytes | None]]) -> bytes:
    """The root above a node: per level its place and its sibling, if any."""
    for place, sibling in path:
        if sibling is None:
            node = digest(node)
        else:
            node = digest(sibling, node) if place & 1 else digest(node, sibling)
    return node


def proofs(manifest: Manifest, id_type: T.DataType, top_nodes: int = TOP_NODES) -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof digest, root folded from the altered or original leaf, verdict."""
    n_trees, root, bits = manifest.n_trees, manifest.root.encode(), manifest.bits

    def shared(known: Mapping[Place, bytes], tree: int, n: int, idx: int, level: int) -> list[tuple[int, bytes | None]]:
        steps = range(level, height(n))
        return [(i, known.get((tree, k, i ^ 1))) for k in steps for i in [idx >> (k - level)]]

    def expand(rows: pa.Table, others: pa.Table) -> pa.Table:
        tree, n = rows.column("tree")[0].as_py(), rows.column("n")[0].as_py()
        pos = rows.column("pos").to_pylist()
        leaves = [d.hex().encode() for d in rows.column("leaf").to_pylist()]
        second = [d.hex().encode() if d else a for a, d in zip(leaves, rows.column("altered").to_pylist())]
        lists = others.column("nodes").to_pylist()
        known = {(v["want"], v["level"], v["idx"]): v["digest"] for v in (lists[0] if lists else [])}
        level = min(bits, height(n))
        levels = above(dict(zip(pos, leaves)), n, 0, level)
        [(idx, top)] = levels[level].items()
        to_sub = shared(known, tree, n, idx, level)
        to_root = shared(known, TOP_TREE, n_trees, tree, 0)
        subroot = fold(top, to_sub)
        rest = b"".join(d for _, d in [*to_sub, *to_root] if d)
        folded = {top: fold(subroot, to_root)}
        made = []
        for p, own, changed in zip(pos, leaves, second):
            path = [(p >> k, levels[k].get((p >> k) ^ 1)) for k in range(level)]
            proof = digest(*[d for _, d in path if d], rest)
            node = fold(changed, path)
            if node not in folded:
                folded[node] = fold(fold(node, to_sub), to_root)
            end = folded[node]
            made.append([v.decode() for v in (own, subroot, root, proof, end)] + [end == root])
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        columns = [pa.array(c) for c in zip(*made)]
        return pa.Table.from_arrays([rows.column("id"), *columns], names=["id", *names])

    schema = T.StructType(
        [T.StructField("id", id_type)]
        + [T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [T.StructField("verified", T.BooleanType())]
    )
    blocks = manifest.leaves.withColumn("block", F.shiftright("pos", bits)).groupBy("tree", "block")
    return blocks.cogroup(fetched(manifest, top_nodes).groupBy("tree", "block")).applyInArrow(expand, schema)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def verify(docs: DataFrame, altered: Mapping[str, Column] | None = None, where: Column | None = None,
           id_col: str = "doc_id", tree_col: str = "lang", columns: Sequence[str] = COLUMNS,
           bits: int = BITS, top_nodes: int = TOP_NODES) -> DataFrame:
    """Build the manifest of ``docs`` and prove every row against its root, rows ``where`` as ``altered``.

    One row per row of ``docs``.  Null values are part of the leaf as such; rows
    without an id come first in their tree, rows with one id in the order of their
    leaves, and repeated rows are leaves of their own with proofs of their own.  Null
    is a tree like any language.  A table of one row has an empty proof, an empty table
    no rows.  Columns that are not named are not read.  Calling it runs jobs.
    """
    with scratch(docs.sparkSession):
        manifest = build(docs, columns, tree_col, id_col, altered, where, bits)
        result = proofs(manifest, docs.schema[id_col].dataType, top_nodes).withColumnRenamed("id", id_col)
        return saved(result, "manifest-proofs", outlives=True)
