"""Interleaving of sources at target weights by proportionate-fair scheduling.

Each source's documents, in order of a hash of their id, are cut into blocks of bytes. Time runs in slots of one
block each. With a weight of a/Q, block i of a source may run from its release floor(i*Q/a) on and must have run by
its deadline ceil((i+1)*Q/a). Earliest-deadline-first over released blocks meets all deadlines, as the weights add
up to one, so that after any number of slots every source is less than one block off its share.

The schedule repeats after Q slots, so it is made once for Q slots, whose number is a parameter, and every block
finds its slot in that table. A source that has run out leaves its slots empty; the others' order stays as it is.
"""

from __future__ import annotations

import heapq
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deedmill.functions.local import local_table
from deedmill.llm.common import shared_folder

#: Slots after which the schedule repeats; weights are rounded to this many shares.
SLOTS = 1000
BLOCK_BYTES = 1 << 15
#: Leading characters of the hash that documents of a source are bucketed by.
BUCKET_CHARACTERS = 3
REST = "*"


def shares(weights: dict[str, float], slots: int = SLOTS) -> dict[str, int]:
    """Whole shares of `slots`, one at least each, by largest remainders; a missing rest gets the weight left over from 1."""
    if any(w <= 0 for w in weights.values()) or len(weights) >= slots:
        raise ValueError("weights must be positive and fewer than the slots")
    total = sum(weights.values())
    full = dict(weights) if REST in weights else weights | {REST: max(1 - total, total / slots)}
    total = sum(full.values())
    exact = {s: w / total * slots for s, w in full.items()}
    found = {s: max(1, int(x)) for s, x in exact.items()}
    by_remainder = sorted(full, key=lambda s: (found[s] - exact[s], s))
    i = 0
    while (left := slots - sum(found.values())) > 0:
        found[by_remainder[i % len(by_remainder)]] += 1
        i += 1
    while left < 0:
        found[max(found, key=lambda s: (found[s] - exact[s], found[s]))] -= 1
        left += 1
    return found


def schedule(share: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, share, block, slot, slots) for each slot until the schedule repeats."""
    slots = sum(share.values())
    blocked = [(0, s, 0) for s in share]
    ready: list[tuple[int, str, int]] = []
    heapq.heapify(blocked)
    found = []
    for slot in range(slots):
        while blocked and blocked[0][0] <= slot:
            _, source, i = heapq.heappop(blocked)
            heapq.heappush(ready, (-(-(i + 1) * slots // share[source]), source, i))
        _, source, i = heapq.heappop(ready)
        found.append((source, share[source], i, slot, slots))
        if i + 1 < share[source]:
            heapq.heappush(blocked, ((i + 1) * slots // share[source], source, i + 1))
    return found


def _pool(share: dict[str, int]) -> Column:
    named = F.col("row.source").cast("string")
    return F.when(named.isin([s for s in share if s != REST]), named).otherwise(REST)


def _size() -> Column:
    return F.coalesce(F.octet_length(F.col("row.text").cast("string")), F.lit(0)).cast("long")


def _with_slots(rows: DataFrame, share: dict[str, int], block_bytes: int) -> DataFrame:
    """Rows of `pool` and `start` with their block, the share and slots of the schedule, and their slot."""
    rows = rows.withColumn("block", F.floor(F.col("start") / F.lit(block_bytes)).cast("long"))
    names = ["pool", "share", "turn", "place", "slots"]
    columns = dict(zip(names, map(list, zip(*schedule(share), strict=True)), strict=True))
    types = dict.fromkeys(names, pa.int64()) | {"pool": pa.string()}
    table = local_table(rows.sparkSession, columns, types)
    # The table has `slots` rows, and its shares one row a pool.
    rows = rows.join(F.broadcast(table.select("pool", "share").distinct()), "pool")
    rows = rows.withColumn("turn", F.col("block") % F.col("share"))
    rows = rows.join(F.broadcast(table.drop("share")), ["pool", "turn"])
    return rows.withColumn("slot", F.expr("(block div share) * slots + place"))


def place(docs: DataFrame, weights: dict[str, float], slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`row`, a struct of all columns of a row of `docs`, with pool, block, release, deadline, slot, start and key.

    A source without a weight, null included, belongs to the pool `*` of all such sources. A null or empty text has no
    bytes and starts where its neighbour does. A document starts in its block and may reach beyond it; blocks in
    which none starts stay empty. Ties in the order are broken by id and text; repeated rows are placed one after
    the other. No rows give no rows. The order to read in is slot, start, key.
    """
    share = shares(weights, slots)
    rows = docs.select(F.struct("*").alias("row")).withColumns({"pool": _pool(share), "size": _size()})
    key = F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_CHARACTERS))
    # Sums of buckets, of which a pool has 4,096 at most, place a bucket in its pool.
    totals = rows.groupBy("pool", "bucket").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("pool").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("pool", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    order = [F.col("key"), F.col("row.doc_id"), F.md5(F.coalesce(F.col("row.text").cast("string"), F.lit("")))]
    inside = Window.partitionBy("pool", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["pool", "bucket"])
    rows = rows.withColumn("start", F.col("offset") + F.col("inside"))
    rows = _with_slots(rows, share, block_bytes)
    return rows.select(
        "row", "pool", "block",
        F.expr("block * slots div share").alias("release"),
        F.expr("((block + 1) * slots + share - 1) div share").alias("deadline"),
        "slot", "start", "key",
    )


def mixed(docs: DataFrame, weights: dict[str, float], slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns of `docs` in the order of the mix: partitions, and files written from them, follow each other."""
    placed = place(docs, weights, slots, block_bytes)
    return placed.repartitionByRange("slot", "start", "key").sortWithinPartitions("slot", "start", "key").select("row.*")


def _in_order(docs: DataFrame) -> DataFrame:
    """`row`, a struct of all columns, with `part` and `at`, its place in the order of `docs`.

    Files are in the order of their names. Other rows, whose order is that of their partitions, are written first, as
    partitions may be made anew each time they are read.
    """
    row = F.struct("*").alias("row")
    # Metadata are seen through an alias of files, but not of what is computed from them.
    try:
        return docs.alias("docs").select(row, F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        path = f"{shared_folder(docs.sparkSession)}/order-{uuid.uuid4()}"
        docs.write.parquet(path)
        return _in_order(docs.sparkSession.read.schema(docs.schema).parquet(path))


def slots_in_order(docs: DataFrame, weights: dict[str, float], slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`row`, a struct of all columns of a row of `docs`, and the `slot` it falls into when each source's documents come in the order of `docs`.

    What `mixed` has put in order falls into the slots that `place` gave it.
    """
    share = shares(weights, slots)
    rows = _in_order(docs)
    rows = rows.withColumns({"pool": _pool(share), "size": _size()})
    # One sum for each pool of each file.
    totals = rows.groupBy("pool", "part").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("pool").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("pool", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("pool", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, ["pool", "part"])
    rows = rows.withColumn("start", F.col("offset") + F.col("inside"))
    return _with_slots(rows, share, block_bytes).select("row", "slot")


#: Target weights of the query and the pipeline; sources not named share the rest.
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.1} | {f"src{i}": 0.05 for i in range(4, 10)}


def query(docs: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Places of all documents."""
    return place(docs.select("doc_id", "source", "text"), weights).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "pool", "block", "release", "deadline", "slot"
    )


def sql(weights: dict[str, float] = WEIGHTS, slots: int = SLOTS, block_bytes: int = BLOCK_BYTES) -> str:
    """The same in SQL. The table of slots follows from the weights alone; tests hold it against the definition."""
    table = ", ".join(f"('{pool}', {a}, {turn}, {at})" for pool, a, turn, at, _ in schedule(shares(weights, slots)))
    return f"""
WITH slot_table(pool, share, turn, place) AS (VALUES {table}),
sized AS (
  SELECT doc_id, source, CASE WHEN source IN (SELECT pool FROM slot_table WHERE pool <> '{REST}') THEN source ELSE '{REST}' END AS pool,
         coalesce(strlen(text), 0) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key, md5(coalesce(text, '')) AS tie
  FROM documents),
placed AS (
  SELECT doc_id, source, pool, coalesce(sum(size) OVER (PARTITION BY pool ORDER BY key, doc_id, tie
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {block_bytes} AS block
  FROM sized)
SELECT doc_id, source, p.pool, CAST(block AS BIGINT) AS block,
       CAST(block * {slots} // share AS BIGINT) AS release,
       CAST(((block + 1) * {slots} + share - 1) // share AS BIGINT) AS deadline,
       CAST((block // share) * {slots} + place AS BIGINT) AS slot
FROM placed p JOIN slot_table t ON p.pool = t.pool AND p.block % t.share = t.turn
"""
