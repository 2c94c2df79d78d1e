"""Comparison of all values that share a key, in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values of a key that one tile holds.
TILE = 2048

Near = Callable[[np.ndarray], Iterable[tuple[int, np.ndarray]]]


def forest(n: int, near: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """Pairs i, j that span the components of n values. `near` gives rows i with a boolean line of what is near i."""
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    found: list[tuple[int, int]] = []
    for i, line in near:
        for j in np.unique(root[np.nonzero(line)[0]]).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((i, j))
    return np.array(found, np.int64).reshape(-1, 2)


def links(keyed: DataFrame, near: Near, kind: str, tile: int = TILE) -> DataFrame:
    """Pairs a, b of values under one key that span what `near` finds among them.

    `keyed` has the columns which (int), key (long) and value, of the type `kind`, without repeats. A key with
    more values than a tile holds is cut into tiles, and a task compares two tiles at a time: each pair of values
    meets, whatever their number.
    """
    sizes = keyed.groupBy("which", "key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = keyed.join(sizes, ["which", "key"]).withColumn("tiles", F.ceil(F.col("n") / F.lit(tile)).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("value"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    group = ["which", "key", "x", "y"]
    dealt = dealt.select("which", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(groups: list[np.ndarray]) -> pa.RecordBatch:
            pairs = [(values, forest(len(values), near(values))) for values in groups]
            columns = [np.concatenate([values[p[:, side]] for values, p in pairs]) for side in (0, 1)]
            return pa.record_batch([pa.array(c, pa.from_numpy_dtype(c.dtype) if c.dtype != object else pa.string()) for c in columns], ["a", "b"])

        rest, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            values = batch.column(4).to_numpy(zero_copy_only=False)
            groups = np.split(values, np.nonzero((keys[1:] != keys[:-1]).any(axis=1))[0] + 1)
            if last is not None and (keys[0] == last).all():
                groups[0] = np.concatenate([rest, groups[0]])
            elif last is not None:
                groups.insert(0, rest)
            rest, last = groups.pop(), keys[-1]
            if groups := [g for g in groups if len(g) > 1]:
                yield linked(groups)
        if last is not None and len(rest) > 1:
            yield linked([rest])

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, f"a {kind}, b {kind}")


def crowds(met: DataFrame, tile: int, room: int, size: Column) -> DataFrame:
    """root, node, tiles and own, the node's tile, for each member of the components `met` (node and root, as components gives them).

    A tile has about `tile` nodes at most, whose `size`, an expression of node, adds up to about `room` at most.
    """
    members = met.unionByName(met.select(F.col("root").alias("node"), "root").distinct())
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    least = F.greatest(F.ceil(F.col("n") / F.lit(tile)), F.ceil(F.col("size") / F.lit(room)))
    sizes = sizes.select("root", least.cast("int").alias("tiles"))
    return members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))


def text_links(texts: DataFrame, near: Callable[[list[str]], Iterable[tuple[int, np.ndarray]]], kind: str) -> DataFrame:
    """Pairs a, b of nodes that span what `near` finds among the texts of each crowd, two of its tiles at a time.

    `texts` has what crowds gives, and packed, the node's compressed text, a row for each node of the type `kind`.
    """
    pairs = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    pairs = pairs.select("root", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = pa.string() if kind == "string" else pa.int64()

        def linked(rows: list[tuple]) -> pa.RecordBatch:
            found = []
            if len(rows) > 1:
                found = forest(len(rows), near([zstandard.decompress(r[1]).decode("utf-8", "surrogatepass") for r in rows])).tolist()
            return pa.record_batch([pa.array([rows[p[side]][0] for p in found], types) for side in (0, 1)], ["a", "b"])

        last, rows = None, []
        for batch in batches:
            for *group, node, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != last and rows:
                    yield linked(rows)
                    rows = []
                last = group
                rows.append((node, packed))
        if rows:
            yield linked(rows)

    group = ["root", "x", "y"]
    return pairs.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, f"a {kind}, b {kind}")
