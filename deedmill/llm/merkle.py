"""A content-addressed manifest of a data set: a Merkle tree for each language, and one over their roots.

What is stored are records, digest to children. A record stands for LEVELS levels of the binary tree: its children
are the nodes so many levels below, the nodes between are hashed again when they are needed. So a tree of a billion
leaves is three records deep, and a record holds 2 ** LEVELS digests at most.

Leaves are proven by descent. A request is a leaf's place in its tree, and its digits in base 2 ** LEVELS name the
child to take in each record from the root down; the siblings that are not taken are collected on the way. Requests
with the same leading digits go down together, so a record is looked up once for all leaves below it. At the leaf
the collected segments are reversed, which gives the proof from the leaf up.

Places are counted in parts of a range-partitioned, sorted table, so no tree, however large, is ordered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedmill.llm.common import checkpoint, map_batches

#: Binary levels in a record; a record has two to the power of this many children at most.
LEVELS = 10
#: Tampering changes the rows whose crc32 of the id this divides.
TAMPER = 7
_DIGEST = 32
#: What a step of a path says of the node's sibling.
_ALONE, _RIGHT, _LEFT = 0, 1, 2

PROOF_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


@dataclass(frozen=True)
class Manifest:
    """What a manifest stores.

    records: digest, children (digests one after the other) and height, the binary levels between them.
    trees: lang, leaves (their number), digest (the tree's root) and place, its rank among the languages.
    requests: tree (the lang), place of a block of leaves under one record, and leaves, its rows.
    root; langs, the number of trees; and levels, the binary levels of a record.
    """

    records: DataFrame
    trees: DataFrame
    requests: DataFrame
    root: bytes | None
    langs: int
    levels: int


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and tampered, the leaf after tampering (null where nothing is tampered with), for each row."""
    doc_id, chars = F.col("doc_id").cast("long"), F.col("n_chars").cast("long")
    fields = [_field(doc_id), _field(F.col("source")), _field(F.col("lang"))]
    digest = lambda n: F.unhex(F.sha2(F.concat(*fields, _field(n), _field(F.col("text"))), 256))
    hit = (F.crc32(doc_id.cast("string").cast("binary")) % TAMPER == 0) & chars.isNotNull()
    return docs.select(
        doc_id.alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        digest(chars).alias("leaf"),
        F.when(hit, digest(chars.cast("decimal(20,0)") + 1)).alias("tampered"),
    )


def _placed(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """`rows` with place, the number of rows before a row in its tree, and size, the tree's number of rows."""
    sorted_rows = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # Written, so that part and at stay as they are, whatever is computed again.
    dealt = checkpoint(sorted_rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    runs = dealt.groupBy(tree, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(tree)
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    runs = runs.select(F.col(tree).alias("_tree"), F.col("part").alias("_part"), (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    met = dealt.join(runs, dealt[tree].eqNullSafe(runs["_tree"]) & (F.col("part") == F.col("_part")))
    return met.select(*rows.columns, (F.col("at") + F.col("shift")).alias("place"), "size")


def _node(children: list[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def levels_of(children: list[bytes], height: int) -> list[list[bytes]]:
    """The nodes of a record level by level, from its children up to the one it stands for."""
    levels = [children]
    for _ in range(height):
        below = levels[-1]
        levels.append([_node(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _split(children: bytes) -> list[bytes]:
    return [children[i : i + _DIGEST] for i in range(0, len(children), _DIGEST)]


def _lifted(blocks: DataFrame, levels: int) -> DataFrame:
    """The records of `blocks` (tree, place, size, children), with place and size as nodes of the next level."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tree, place, sizes, children = batch.column(0), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        heights = [min(levels, (n - 1).bit_length()) for n in sizes]
        digests = [levels_of(c, h)[-1][0] for c, h in zip(children, heights, strict=True)]
        made = [[-(-n >> levels) for n in sizes], digests, [b"".join(c) for c in children], heights]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.int32()]
        arrays = [pa.array(c, t) for c, t in zip(made, types, strict=True)]
        return pa.record_batch([tree, place, *arrays], ["tree", "place", "size", "digest", "children", "height"])

    schema = "tree string, place long, size long, digest binary, children binary, height int"
    return map_batches(blocks.select("tree", "place", "size", "children"), run, schema)


def _block(levels: int) -> Column:
    return F.shiftright("place", levels).alias("place")


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes of a level (tree, place, size, digest) by record; a record's list of children is bounded."""
    listed = F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), "digest")))
    grouped = nodes.groupBy("tree", _block(levels), "size").agg(listed.alias("listed"))
    return grouped.select("tree", "place", "size", F.col("listed.digest").alias("children"))


def _grown(blocks: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Records of all levels over `blocks`, and tree and digest of the roots. Trees of one node have no block."""
    records, roots = [], []
    while True:
        lifted = checkpoint(_lifted(blocks, levels))
        records.append(lifted.select("digest", "children", "height"))
        roots.append(lifted.where("size = 1").select("tree", "digest"))
        nodes = lifted.where("size > 1")
        if nodes.isEmpty():
            return records, reduce(DataFrame.union, roots)
        blocks = _blocks(nodes, levels)


def build(docs: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of all rows of `docs` (doc_id, source, lang, n_chars, text; other columns are ignored).

    Nulls in any column are hashed as `-`; rows with a null lang have a tree of their own, the first. Leaves of one
    doc_id, and those without one, follow by their digest; repeated rows are leaves of their own. No rows give no
    records and no root.
    """
    # Written before they are sorted, so that texts are read once.
    placed = _placed(checkpoint(leaves(docs).withColumnRenamed("lang", "tree")), "tree", "doc_id", "leaf")
    leaf = F.struct(F.col("place").alias("at"), "doc_id", "leaf", "tampered")
    # A block's list of leaves is as long as a record's of children.
    requests = checkpoint(placed.groupBy("tree", _block(levels), "size").agg(F.sort_array(F.collect_list(leaf)).alias("leaves")))
    below, roots = _grown(requests.where("size > 1").select("tree", "place", "size", F.col("leaves.leaf").alias("children")), levels)
    roots = roots.union(requests.where("size = 1").select("tree", F.element_at("leaves.leaf", 1)))
    sizes = requests.where("place = 0").select(F.col("tree").alias("lang"), F.col("size").alias("leaves"))
    trees = roots.join(sizes, F.col("tree").eqNullSafe(F.col("lang"))).select(F.lit("").alias("tree"), "lang", "leaves", "digest")

    trees = checkpoint(_placed(trees, "tree", "lang"))
    above, root = _grown(_blocks(trees.where("size > 1"), levels), levels)
    root = root.union(trees.where("size = 1").select("tree", "digest")).first()
    records = reduce(DataFrame.union, below + above).dropDuplicates(["digest"])
    langs = trees.select("size").first()
    trees = trees.select("lang", "leaves", "digest", "place")
    return Manifest(records, trees, requests, bytes(root[1]) if root else None, langs[0] if langs else 0, levels)


def _depth(size: Column, levels: int) -> Column:
    """Records between the root of a tree of so many leaves and a leaf."""
    return reduce(Column.__add__, [(size > F.lit(1 << at)).cast("int") for at in range(0, 63, levels)])


def _step(level: list[bytes], at: int) -> tuple[int, bytes]:
    """Where the sibling of a node is, and its digest."""
    if at ^ 1 >= len(level):
        return _ALONE, b""
    return (_LEFT, level[at - 1]) if at % 2 else (_RIGHT, level[at + 1])


def _segment(levels: list[list[bytes]], child: int) -> list[tuple[int, bytes]]:
    """The siblings that are not taken on the way from a record's root down to a child."""
    return [_step(levels[i], child >> i) for i in reversed(range(len(levels) - 1))]


def _packed(steps: Iterable[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([where]) + digest for where, digest in steps)


def _unpacked(path: bytes) -> list[tuple[int, bytes]]:
    steps, at = [], 0
    while at < len(path):
        end = at + 1 + (_DIGEST if path[at] != _ALONE else 0)
        steps.append((path[at], path[at + 1 : end]))
        at = end
    return steps


def _descended(frontier: DataFrame, records: DataFrame, levels: int) -> DataFrame:
    """One record down: the children of the nodes of `frontier` (tree, place, depth, digest, path, subroot)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, place, depth, path, subroot, children, height in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes = levels_of(_split(children), height)
                n, first = len(nodes[0]), place << levels
                paths = [path + _packed(_segment(nodes, i)) for i in range(n)]
                rows = [[tree] * n, range(first, first + n), [depth - 1] * n, nodes[0], paths, [subroot] * n]
                types = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)

    names = ["tree", "place", "depth", "digest", "path", "subroot"]
    met = frontier.join(records, "digest").select("tree", "place", "depth", "path", "subroot", "children", "height")
    return met.mapInArrow(run, "tree string, place long, depth int, digest binary, path binary, subroot binary")


def _down(frontier: DataFrame, records: DataFrame, least: int, levels: int) -> DataFrame:
    """Descend until no node of `frontier` is more than `least` records above the leaves."""
    done = []
    while True:
        done.append(frontier.where(F.col("depth") <= least))
        frontier = frontier.where(F.col("depth") > least)
        if frontier.isEmpty():
            return reduce(DataFrame.union, done)
        frontier = checkpoint(_descended(frontier, records, levels))


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, a row for each leaf of the manifest.

    The proof is hashed from the leaf up. folded_root goes up from the tampered leaf where there is one, else from
    the leaf, by the siblings of the proof; verified tells whether that is the root. A row without doc_id is not
    tampered with. A tree of one leaf under no other has an empty proof.
    """
    root, records, binary = manifest.root, manifest.records, manifest.levels
    none = F.lit(None).cast("binary")
    start = manifest.trees.where("place = 0").select(
        F.lit("").alias("tree"), "place", _depth(F.lit(manifest.langs), binary).alias("depth"), F.lit(root or b"").alias("digest"), F.lit(b"").alias("path"), none.alias("subroot")
    )
    tops = _down(start, records, 0, binary).select("place", "path")
    trees = manifest.trees.join(tops, "place").select(
        F.col("lang").alias("tree"), F.lit(0).cast("long").alias("place"), _depth(F.col("leaves"), binary).alias("depth"), "digest", "path", F.col("digest").alias("subroot")
    )
    frontier = _down(trees, records, 1, binary).select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "digest", "path", "subroot")
    met = manifest.requests.join(frontier, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("place") == F.col("_place")))
    met = met.join(records, "digest", "left").select("path", "subroot", "children", "height", "leaves")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(proofs(row)), schema)

    def proofs(row: dict) -> Iterator[dict]:
        levels = levels_of(_split(row["children"]), row["height"]) if row["children"] else None
        above = _unpacked(row["path"])[::-1]
        for request in row["leaves"]:
            child = request["at"] & ((1 << binary) - 1)
            steps = [*_segment(levels, child)[::-1], *above] if levels else above
            leaf = levels[0][child] if levels else request["leaf"]
            node = request["tampered"] or leaf
            for where, sibling in steps:
                node = _node([node] if where == _ALONE else [sibling, node] if where == _LEFT else [node, sibling])
            proof = hashlib.sha256("".join(sibling.hex() for _, sibling in steps).encode()).hexdigest()
            yield {
                "doc_id": request["doc_id"], "leaf": leaf.hex(), "subroot": row["subroot"].hex(), "root": root.hex(),
                "proof_sha256": proof, "folded_root": node.hex(), "verified": node == root,
            }

    text = pa.string()
    schema = pa.schema([("doc_id", pa.int64()), *((n, text) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])
    return met.mapInArrow(run, PROOF_SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return prove(build(docs))
