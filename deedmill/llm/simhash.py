"""Near duplicates by SimHash fingerprints, compared bit plane by bit plane.

Fingerprints within the radius agree in all but `radius` of `radius + 2` or more blocks of bits. Every choice of
agreeing blocks gives a table whose key those blocks are, so linked fingerprints meet under a key in some table.
Under a key, the fingerprints' bits are stored vertically: plane b holds bit b of 64 fingerprints in each word.
One XOR with a broadcast bit then gives that bit's difference for 64 pairs, two carry-save counter words add it
up, and rows of pairs are dropped as soon as every pair in them exceeds the radius.

Keys with many fingerprints are cut into tiles, and each pair of tiles is a task's work of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedmill.llm import tiles
from deedmill.llm.common import checkpoint, id_and_text, map_batches
from deedmill.llm.components import components
from deedmill.llm.tiles import Near

WORDS_IN_SHINGLE = 3
HASH_SEED = 42
RADIUS = 2
#: Bits of the blocks that keys are made of.
BLOCKS = (13, 13, 13, 13, 12)
ROWS_AT_ONCE = 1 << 17


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, the lowest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        part = hashes[at : at + ROWS_AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit SimHash of a whole text; zero if it has no word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), WORDS_IN_SHINGLE
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) < n:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], HASH_SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    set_bits = np.nonzero(2 * _bit_counts(hashes) > len(hashes))[0]
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed long of the same bits, a row for each row of `docs`."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.fromiter((fingerprint(t) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
        return pa.record_batch([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return map_batches(id_and_text(docs), run, "doc_id long, print long")


def _block_keys(blocks: tuple[int, ...], radius: int) -> list[int]:
    """A mask of agreeing bits for each choice of blocks."""
    starts = np.cumsum((0, *blocks))
    masks = [((1 << size) - 1) << int(start) for size, start in zip(blocks, starts, strict=False)]
    return [sum(chosen) for chosen in combinations(masks, len(blocks) - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of packed bits; bit j of plane b is bit b of print j."""
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(len(prints), 8), axis=1, bitorder="little").T
    packed = np.packbits(bits, axis=1, bitorder="little")
    room = np.zeros((64, -(-packed.shape[1] // 8) * 8), np.uint8)
    room[:, : packed.shape[1]] = packed
    return room.view("<u8")


def near_rows(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `left` with a print of `right` within the radius, and for each of them a boolean row over `right`."""
    planes, words = _planes(right), -(-len(right) // 64)
    alive = np.arange(len(left))
    levels = max(1, radius.bit_length())
    counters = [np.zeros((len(left), words), np.uint64) for _ in range(levels)]
    beyond = np.zeros((len(left), words), np.uint64)
    unused = np.zeros(words * 64, bool)
    unused[len(right) :] = True
    padding = np.packbits(unused, bitorder="little").view("<u8")

    def exceeded() -> np.ndarray:
        """Bits of pairs whose counter is over the radius: compares the counter with the constant from the top bit down."""
        over, same = beyond.copy(), ~beyond
        for level in reversed(range(levels)):
            if radius >> level & 1:
                same &= counters[level]
            else:
                over |= same & counters[level]
                same &= ~counters[level]
        return over | padding

    for bit in range(64):
        flips = np.where((left[alive] >> np.uint64(bit)) & np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        carry = planes[bit][None, :] ^ flips[:, None]
        for level in range(levels):
            counters[level], carry = counters[level] ^ carry, counters[level] & carry
        beyond |= carry
        if bit % 8 == 7:
            keep = (exceeded() != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
            if not keep.all():
                alive, beyond = alive[keep], beyond[keep]
                counters = [c[keep] for c in counters]
            if not len(alive):
                break
    near = ~exceeded()
    return alive, np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(right)].astype(bool)


def _near(radius: int) -> Near:
    def near(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        prints = values.view(np.uint64)
        for at in range(0, len(prints), 256):
            rows, lines = near_rows(prints[at : at + 256], prints, radius)
            yield from zip((rows + at).tolist(), lines, strict=True)

    return near


def links(prints: DataFrame, radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS, tile: int = tiles.TILE) -> DataFrame:
    """Pairs a, b that join all distinct values of `prints`.print within the radius; chains of pairs stand for the rest."""
    distinct = prints.select("print").distinct()
    masks = _block_keys(blocks, radius)
    keyed = distinct.select(
        F.posexplode(F.array(*[F.col("print").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("which", "key"), F.col("print").alias("value")
    )
    return tiles.links(keyed, _near(radius), "long", tile)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS, tile: int = tiles.TILE) -> DataFrame:
    """doc_id, print and component_id, the smallest doc_id that links lead to, a row for each row of `docs`.

    A null or empty text, or one of white space alone, has the print zero and is linked like any other. A null
    doc_id stays null and names no component; a component of such rows alone has a null component_id. Repeated
    rows give repeated results. No rows give no rows. Other columns are ignored.
    """
    prints = checkpoint(fingerprints(docs))
    roots = components(links(prints, radius, blocks, tile))
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("print", "component_id")
    return prints.join(classes, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, near: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """The rows of `docs` whose doc_id names its component by `near`, once each; all columns.

    Of rows with equal doc_id and text one stays. A row without doc_id cannot be named and stays.
    """
    found = near(docs)
    named = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    kept = docs.join(named, docs["doc_id"].cast("long") == named["_kept"], "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id is null"))


def query(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
