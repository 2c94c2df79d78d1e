"""Nearest neighbours by inner product through a few stable projections.

A coordinate that brings all vectors to the same length turns the largest inner product into the least distance.
Projections on a few Gaussian directions keep distances in distribution: the squared projected distance, over the
squared distance, is chi-square. A kd-tree over the projections deals all vectors out to cells. A query goes
through cells in order of their projected distance and verifies their vectors with full inner products, until
a chi-square test says that a vector nearer than its k-th best would very likely have been met by now.

Equal vectors are searched once; results name all their rows. The kd-tree is made from a bounded sample; every vector
is put in a cell. Cells are read in tiles of bounded size with queries streaming through, so no cell and no
crowd of queries has to fit in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedmill.llm.common import checkpoint

#: Projections (even), the tree's depth and the sample that it is made from.
PROJECTIONS, DEPTH, SAMPLE, SEED = 8, 8, 8192, 11
#: How likely a nearer vector must be to have been met before a query stops.
SURE = 0.97
#: Vectors in a tile; queries that one task streams through it.
TILE, QUERIES = 4096, 65_536
#: Cells that a query may have gone through after each round; the bound on its distance is renewed between rounds.
ROUNDS = (8, 48, 1 << DEPTH)
SLACK = 8


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**j / math.factorial(j) for j in range(freedom // 2))


def chi_square_bound(sure: float, freedom: int = PROJECTIONS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < sure else (low, middle)
    return high


def valid(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vec (doubles) and h1, h2, 128 bits that name the vector; without null, zero, and non-finite vectors."""
    vec = F.transform(F.col(vector_column), lambda x: x.cast("double") + F.lit(0.0))
    found = rows.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = found.where(~F.coalesce(bad, F.lit(True)) & F.exists("vec", lambda x: x != 0))
    return found.withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(SEED), "vec"))


@dataclass(frozen=True)
class Tree:
    """Directions, and the axis and cut of every inner node of a full binary tree, the root first."""

    directions: np.ndarray
    axes: np.ndarray
    cuts: np.ndarray
    longest: float

    @staticmethod
    def make(sample: np.ndarray, longest: float) -> Tree:
        random = np.random.default_rng(SEED)
        directions = random.normal(size=(sample.shape[1] + 1, PROJECTIONS))
        tree = Tree(directions, np.zeros(2**DEPTH - 1, np.int64), np.zeros(2**DEPTH - 1), longest)
        parts = [tree.project(sample)]
        for node in range(2**DEPTH - 1):
            part = parts[node]
            if len(part):
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                cut = float(np.median(part[:, axis]))
                tree.axes[node], tree.cuts[node] = axis, cut
                right = part[:, axis] > cut
                parts += [part[~right], part[right]]
            else:
                parts += [part, part]
        return tree

    def project(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Candidates get the coordinate that brings them to the longest length; queries have 0 there."""
        own = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.longest - (vectors**2).sum(axis=1)))
        return vectors @ self.directions[:-1] + own[:, None] * self.directions[-1]

    def cells(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), np.int64)
        for _ in range(DEPTH):
            right = projected[np.arange(len(projected)), self.axes[node]] > self.cuts[node]
            node = 2 * node + 1 + right
        return node - (2**DEPTH - 1)


@dataclass(frozen=True)
class Cells:
    """Boxes around the cells' projected vectors, and the tiles that each cell's vectors are dealt to."""

    low: np.ndarray
    high: np.ndarray
    first_tile: np.ndarray
    tiles: np.ndarray

    @staticmethod
    def make(rows: list) -> Cells:
        n = 1 << DEPTH
        low, high = np.full((n, PROJECTIONS), np.inf), np.full((n, PROJECTIONS), -np.inf)
        first, tiles = np.zeros(n, np.int64), np.zeros(n, np.int64)
        tile, room = -1, 0
        for r in sorted(rows, key=lambda r: r["cell"]):
            cell, count = r["cell"], r["n"]
            low[cell] = [r[f"low{i}"] for i in range(PROJECTIONS)]
            high[cell] = [r[f"high{i}"] for i in range(PROJECTIONS)]
            tiles[cell] = -(-count // TILE)
            if tiles[cell] > 1 or count > room:
                first[cell] = tile + 1
                tile += tiles[cell]
                room = TILE if tiles[cell] == 1 else 0
            else:
                first[cell] = tile
            room -= count if tiles[cell] == 1 else 0
        return Cells(low, high, first, tiles)

    def distances(self, projected: np.ndarray) -> np.ndarray:
        """Squared distance of each projected query to each box; infinite for cells without vectors."""
        used = self.tiles > 0
        found = np.full((len(projected), len(self.tiles)), np.inf)
        outside = np.maximum(0, np.maximum(self.low[used][None] - projected[:, None], projected[:, None] - self.high[used][None]))
        found[:, used] = (outside**2).sum(axis=2)
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _per_cell(values: np.ndarray, cell: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), cell + 1)


def _visits(queries: DataFrame, tree: Tree, cells: Cells, done: int, until: int, bound: float) -> DataFrame:
    """A row for each query and tile to go to, with the cells to go through there."""
    shared = queries.sparkSession.sparkContext.broadcast((tree, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, cells = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = _matrix(part.column("vec"))
                kth = np.array([-np.inf if s is None else s for s in part.column("kth").to_pylist()])
                reach = bound * np.maximum(0, (vectors**2).sum(axis=1) + tree.longest - 2 * kth)
                far = cells.distances(tree.project(vectors, query=True))
                order = np.argsort(far, axis=1, kind="stable")[:, done:until]
                near = np.take_along_axis(far, order, axis=1)
                go = np.isfinite(near) & (near <= reach[:, None])
                rows, tiles, lists = [], [], []
                for i in range(part.num_rows):
                    own = order[i][go[i]]
                    parts: dict[int, list[int]] = {}
                    for cell in own.tolist():
                        for tile in range(cells.first_tile[cell], cells.first_tile[cell] + cells.tiles[cell]):
                            parts.setdefault(int(tile), []).append(cell)
                    rows += [i] * len(parts)
                    tiles += parts.keys()
                    lists += parts.values()
                taken = part.take(pa.array(rows, pa.int64()))
                columns = [taken.column(c) for c in ("h1", "h2", "vec", "kth")]
                yield pa.record_batch([*columns, pa.array(tiles, pa.int64()), pa.array(lists, pa.list_(pa.int32()))], ["h1", "h2", "vec", "kth", "tile", "cells"])

    return queries.mapInArrow(run, "h1 long, h2 long, vec array<double>, kth double, tile long, cells array<int>")


def _verified(rows: DataFrame, keep: int) -> DataFrame:
    """q1, q2, c1, c2, least and score: the best vectors of each tile for each query that goes there.

    `rows` come by tile, its vectors first, then the queries.
    """
    names = ["q1", "q2", "c1", "c2", "least", "score"]

    def best(tile: dict[str, np.ndarray], queries: pa.RecordBatch) -> pa.RecordBatch:
        vectors = _matrix(queries.column("vec"))
        kth = np.array([-np.inf if s is None else s for s in queries.column("kth").to_pylist()])
        lists = queries.column("cells")
        going: dict[int, list[int]] = {}
        for i, own in enumerate(lists.to_pylist()):
            for cell in own:
                going.setdefault(cell, []).append(i)
        h1, h2 = (queries.column(c).to_numpy() for c in ("h1", "h2"))
        found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(5)] + [[np.empty(0)]]
        for cell, ids in going.items():
            start, end = np.searchsorted(tile["cell"], [cell, cell + 1])
            if start == end:
                continue
            ids = np.array(ids)
            for at in range(0, len(ids), 512):
                some = ids[at : at + 512]
                scores = vectors[some] @ tile["vec"][start:end].T
                n = min(keep + SLACK, end - start)
                top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                good = np.take_along_axis(scores, top, axis=1) >= (kth[some] - 1e-9 * (1 + np.abs(kth[some])))[:, None]
                r, c = np.nonzero(good)
                q, v = some[r], start + top[r, c]
                # Added up in one order, whatever the tile.
                exact = np.cumsum(vectors[q] * tile["vec"][v], axis=1)[:, -1]
                for to, column in zip(found, (h1[q], h2[q], tile["h1"][v], tile["h2"][v], tile["least"][v], exact), strict=True):
                    to.append(column)
        columns = [np.concatenate(c) for c in found]
        order = np.lexsort((columns[4], -columns[5], columns[1], columns[0]))
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        starts = np.nonzero(new)[0]
        rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        return pa.record_batch([pa.array(c[rank < keep]) for c in columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, tile = None, [], None
        for batch in batches:
            group = np.stack([batch.column(c).to_numpy() for c in ("tile", "salt", "kind")], axis=1)
            cuts = [0, *(np.nonzero((group[1:] != group[:-1]).any(axis=1))[0] + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                piece, (where, salt, kind) = batch.slice(start, end - start), group[start].tolist()
                if (where, salt) != current:
                    current, parts, tile = (where, salt), [], None
                if not kind:
                    parts.append(piece)
                    continue
                if not parts:
                    continue
                if tile is None:
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    by = np.argsort(whole.column("cell").to_numpy(), kind="stable")
                    tile = {c: whole.column(c).to_numpy()[by] for c in ("cell", "h1", "h2", "least")} | {"vec": _matrix(whole.column("vec"))[by]}
                for at in range(0, piece.num_rows, 4096):
                    yield best(tile, piece.slice(at, 4096))

    return rows.mapInArrow(run, "q1 long, q2 long, c1 long, c2 long, least long, score double")


def search(rows: DataFrame, asked: Column, k: int, id_column: str = "vec_id", vector_column: str = "embedding", sure: float = SURE) -> DataFrame:
    """query_id, rank, id and score: the k nearest other rows of each row for which `asked`, a condition on `id`, holds.

    Nearest is the largest inner product in double precision, ties to the smaller id. A row without id, or whose vector
    is null, empty, zero, or has null or non-finite components, takes no part; nor does one of another length
    than the most common (of these, the longest). Repeated rows count once. A query with fewer than k other rows gets
    all of them; no rows give no rows. Other columns are ignored.
    """
    keep = k + 1
    every = valid(rows, id_column, vector_column)
    # A row a vector length.
    sizes = every.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    nothing = rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    if sizes is None:
        return nothing
    every = every.where(F.size("vec") == sizes["size"]).withColumn("asked", asked)
    vectors = every.groupBy("h1", "h2").agg(F.min("vec").alias("vec"), F.min("id").alias("least"), F.bool_or("asked").alias("asked"))
    vectors = checkpoint(vectors)
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    longest = vectors.agg(F.max(square)).first()[0]
    sample = [r["vec"] for r in vectors.orderBy("h1", "h2").limit(SAMPLE).select("vec").collect()]
    tree = Tree.make(np.array(sample), longest)
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            projected = shared.value.project(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros((0, PROJECTIONS))
            cell = pa.array(shared.value.cells(projected), pa.int32())
            columns = [batch.column(c) for c in ("h1", "h2", "vec", "least", "asked")]
            yield pa.record_batch([*columns, cell, pa.array(list(projected), pa.list_(pa.float64()))], ["h1", "h2", "vec", "least", "asked", "cell", "at"])

    schema = "h1 long, h2 long, vec array<double>, least long, asked boolean, cell int, at array<double>"
    index = checkpoint(vectors.mapInArrow(dealt, schema))
    edges = [f(F.col("at")[i]).alias(f"{n}{i}") for f, n in ((F.min, "low"), (F.max, "high")) for i in range(PROJECTIONS)]
    cells = Cells.make(index.groupBy("cell").agg(F.count("*").alias("n"), *edges).collect())
    block = F.pmod(F.col("h1"), _per_cell(np.maximum(1, cells.tiles), F.col("cell"))).cast("long")
    tiled = index.select("h1", "h2", "vec", "least", "cell", (_per_cell(cells.first_tile, F.col("cell")) + block).alias("tile"))
    queries = index.where("asked").select("h1", "h2", "vec", F.lit(None).cast("double").alias("kth"))
    top, bound, done = None, chi_square_bound(sure), 0
    for until in ROUNDS:
        visits = _visits(queries, tree, cells, done, until, bound)
        crowds = visits.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()
        salts = np.ones(1 << DEPTH, np.int64)
        for r in crowds:
            salts[r["cell"]] = -(-r["count"] // QUERIES)
        # Cells in one tile share the largest number of salts among them.
        by_tile = {int(t): int(salts[cells.first_tile == t].max()) for t in np.unique(cells.first_tile)}
        salts = np.array([by_tile[int(t)] for t in cells.first_tile])
        blank = lambda kind: F.lit(None).cast(kind)
        n = _per_cell(salts, F.col("cell"))
        theirs = tiled.withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1))).select(
            "tile", "salt", F.lit(0).alias("kind"), "h1", "h2", "vec", "least", "cell", blank("double").alias("kth"), blank("array<int>").alias("cells")
        )
        n = _per_cell(salts, F.col("cells")[0])
        own = visits.select(
            "tile", F.pmod(F.col("h2"), n).cast("int").alias("salt"), F.lit(1).alias("kind"), "h1", "h2", "vec",
            blank("long").alias("least"), blank("int").alias("cell"), "kth", "cells",
        )
        found = _verified(theirs.unionAll(own).repartition("tile", "salt").sortWithinPartitions("tile", "salt", "kind"), keep)
        found = found if top is None else found.unionAll(top)
        best = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least", "c1", "c2"))
        top = checkpoint(found.withColumn("best", best).where(F.col("best") <= keep).drop("best"))
        kth = top.groupBy("q1", "q2").agg(F.when(F.count("*") >= keep, F.min("score")).alias("kth"))
        queries = queries.drop("kth").join(kth, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")), "left").drop("q1", "q2")
        done = until
    # Of equal vectors no more than the first k + 1 rows can be among the k nearest.
    ids = every.select("id", F.col("h1").alias("c1"), F.col("h2").alias("c2")).distinct()
    ids = ids.withColumn("nth", F.row_number().over(Window.partitionBy("c1", "c2").orderBy("id"))).where(F.col("nth") <= keep)
    pairs = top.join(ids, ["c1", "c2"])
    first = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "id"))
    pairs = pairs.withColumn("first", first).where(F.col("first") <= keep)
    lists = pairs.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("first", "id", "score"))).alias("all"))
    wanted = every.where("asked").select(F.col("id").alias("query_id"), F.col("h1").alias("q1"), F.col("h2").alias("q2")).distinct()
    others = F.slice(F.filter("all", lambda x: x["id"] != F.col("query_id")), 1, k)
    result = wanted.join(lists, ["q1", "q2"]).select("query_id", F.posexplode(others).alias("place", "one"))
    return result.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("one.id").alias("id"), F.col("one.score").alias("score"))


def query(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20."""
    return search(embeddings, F.col("id") % 20 == 0, 20).withColumnRenamed("id", "vec_id")
