"""Exact removal of long byte strings that occur in an earlier document, with a logarithmic family of suffix indexes.

Two documents share a string of 50 bytes exactly if they share a suffix up to its 50th byte. Suffixes that begin
close together are indexed as one piece: every 50-byte string has an anchor, its 24 bytes of least hash, and strings
that begin one after the other and have the same anchor make up a piece. Where a passage is repeated, its pieces
are too; only pieces at its edges differ, though they have an anchor in common. So indexing goes in two steps:

1. Names of pieces. A piece whose name is known from an earlier document is removed as a whole.
2. Each suffix of those other pieces whose anchor is also that of another piece.

A shard's index is a family of sorted arrays. Each new batch of suffixes is sorted, scanned against the existing
levels, and becomes a level itself; levels of like size are merged, so a suffix is copied a logarithmic number of
times. Suffixes are sorted and compared by 64-bit hashes of their 50 bytes, or of the piece's first, middle and last
50, which cover all of its bytes, and its length, within shards chosen by, and for pieces checked with, the anchor's own hash.

A batch hands on each piece or suffix once, for the smallest document in it that has it, so a passage that a third of
all documents have costs its shard one entry a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedmill.llm.common import checkpoint, id_and_text, map_batches

#: Bytes of a string that counts as a repeat, of an anchor, strings of a piece at most, and bytes scanned at once, few enough for a core's cache.
LENGTH, ANCHOR, IN_PIECE, CHUNK = 50, 24, 64, 1 << 16
#: Shards for each shuffle partition; bytes of text read at once; entries that a task deals out at once, and that a family takes as one batch.
SHARDS, AT_ONCE, DEALT, ADDED = 4, 1 << 22, 1 << 19, 1 << 16
#: A level is merged with the one before it if that is no larger than so many times its size.
RATIO = 2

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(29)
    return x


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = left * _B
    x += right
    x *= _A
    x ^= x >> np.uint64(29)
    return x


def _anchor_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 8 bytes, and of the ANCHOR bytes, that begin at each place."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,)).copy()
    words ^= words >> np.uint64(32)
    words = _mix(words)
    anchors = words
    for at in range(8, ANCHOR, 8):
        anchors = _joined(anchors[: len(words) - at], words[at:])
    return words, anchors


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    size, least = 1, values
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _numbers(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of so many items in each group: the group and the number in it, for each item."""
    return np.repeat(np.arange(len(counts)), counts), np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _changes(values: np.ndarray) -> np.ndarray:
    """Which values are not equal to the one before."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


@dataclass(frozen=True)
class Pieces:
    """Pieces of some texts: the text's number, the first string's place in it, strings, anchor and name.

    The strings of piece i begin at first[i] and the count[i] - 1 places after it, of the bytes whose words and anchors are hashed here.
    """

    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    name: np.ndarray
    first: np.ndarray
    words: np.ndarray
    anchors: np.ndarray

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The piece of each string of the chosen pieces, its number in the piece, and its hash."""
        group, inner = _numbers(self.count[chosen])
        piece = chosen[group]
        return piece, inner, _string_hashes(self.words, self.anchors, self.first[piece] + inner)


def _string_hashes(words: np.ndarray, anchors: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each place: two anchors one after the other and the last word cover them."""
    return _joined(_joined(anchors[places], anchors[places + ANCHOR]), words[places + LENGTH - 8])


def _scan_chunk(segments: list[tuple[int, int, bytes]]) -> Pieces:
    data = np.frombuffer(b"".join(s[2] for s in segments), np.uint8)
    sizes = np.array([len(s[2]) for s in segments])
    begins = np.cumsum(sizes) - sizes
    words, anchors = _anchor_hashes(data)
    least = _window_minima(anchors, LENGTH - ANCHOR + 1)
    new = _changes(least)
    # No string goes on from one segment into the next.
    new[begins[1:]] = True
    new[begins[1:, None] - np.arange(1, LENGTH)] = False
    first = np.nonzero(new)[0]
    last = np.append(np.searchsorted(first, begins[1:]), len(first)) - 1
    ends = np.append(first[1:], 0)
    ends[last] = begins + sizes - LENGTH + 1
    segment = np.repeat(np.arange(len(segments)), np.diff(last, prepend=-1))
    if (ends - first > IN_PIECE).any():
        group, inner = _numbers(-((first - ends) // IN_PIECE))
        first, ends, segment = first[group] + inner * IN_PIECE, ends[group], segment[group]
    count = np.minimum(ends - first, IN_PIECE)
    text, offset = np.array([s[0] for s in segments])[segment], np.array([s[1] for s in segments])[segment]
    # No two of the three begin more than LENGTH apart, so every byte of the piece is in the name.
    one, two, three = (_string_hashes(words, anchors, first + at) for at in (0, (count - 1) // 2, count - 1))
    name = _mix(_joined(_joined(one, two), three) + count.astype(np.uint64))
    return Pieces(text, offset + first - begins[segment], count, least[first], name, first, words, anchors)


def scan(texts: list[bytes]) -> Iterator[Pieces]:
    """Pieces of all texts, some texts at a time; very long ones are cut, with an overlap that keeps every string."""
    segments, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, CHUNK):
            part = text[at : at + CHUNK + LENGTH - 1]
            segments.append((number, at, part))
            size += len(part)
            if size >= CHUNK:
                yield _scan_chunk(segments)
                segments, size = [], 0
    if segments:
        yield _scan_chunk(segments)


def _grouped(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key and check, and where in it those of each key and check begin."""
    order = np.argsort(keys)
    new, other = _changes(keys[order]), _changes(checks[order])
    if (other & ~new).any():
        # Rarely has one key several checks.
        order = np.lexsort((checks, keys))
        new = _changes(keys[order]) | _changes(checks[order])
    return order, np.nonzero(new)[0]


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are among the known ones, which are in order."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


class Family:
    """Levels of sorted keys, each with a check value and the smallest document that has the key."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    @staticmethod
    def _sorted(keys: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # Of equal keys and checks, the smallest document stays.
        order, starts = _grouped(keys, checks)
        if not len(keys):
            return keys, checks, docs
        firsts = order[starts]
        return keys[firsts], checks[firsts], np.minimum.reduceat(docs[order], starts)

    def add(self, keys: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> None:
        """Sort a batch, scan it against the levels, and make what is new a level; merge levels of like size."""
        keys, checks, docs = self._sorted(keys, checks, docs)
        fresh = np.ones(len(keys), bool)
        for level in self.levels:
            at, known = self._match(level, keys, checks)
            level[2][at[known]] = np.minimum(level[2][at[known]], docs[known])
            fresh &= ~known
        if fresh.any():
            self.levels.append((keys[fresh], checks[fresh], docs[fresh]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= RATIO * len(self.levels[-1][0]):
            last, before = self.levels.pop(), self.levels.pop()
            self.levels.append(self._sorted(*(np.concatenate(x) for x in zip(before, last, strict=True))))

    @staticmethod
    def _match(level: tuple, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(level[0], keys), len(level[0]) - 1)
        return at, (level[0][at] == keys) & (level[1][at] == checks)

    def smallest(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The smallest document that has each key, all of which are known."""
        found = np.full(len(keys), np.iinfo(np.int64).max)
        for level in self.levels:
            at, known = self._match(level, keys, checks)
            found[known] = level[2][at[known]]
        return found

    def shared_checks(self) -> np.ndarray:
        """Check values that several keys have, not all of them from one document, in order."""
        checks, docs = (np.concatenate([level[i] for level in self.levels]) for i in (1, 2))
        order = np.argsort(checks)
        checks, docs = checks[order], docs[order]
        starts = np.nonzero(_changes(checks))[0]
        return checks[starts][np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)]


@dataclass(frozen=True)
class Batch:
    """What a batch of documents hands to one shard: entries that contend for the smallest document, and repeats already known."""

    keys: np.ndarray
    checks: np.ndarray
    docs: np.ndarray
    known_keys: np.ndarray
    known_docs: np.ndarray

    def packed(self) -> bytes:
        sizes = np.array([len(self.keys), len(self.known_keys)], "<i8")
        # Documents come in order or nearly so, hashes cannot be made smaller.
        docs = zstandard.compress(np.diff(np.concatenate([self.docs, self.known_docs]), prepend=np.int64(0)).astype("<i8").tobytes(), 3)
        return b"".join([sizes.tobytes(), self.keys.tobytes(), self.checks.tobytes(), self.known_keys.tobytes(), docs])

    @staticmethod
    def unpacked(data: bytes) -> Batch:
        n, known = np.frombuffer(data, "<i8", 2).tolist()
        keys = np.frombuffer(data, "<u8", n, 16)
        checks = np.frombuffer(data, "<u4", n, 16 + 8 * n)
        known_keys = np.frombuffer(data, "<u8", known, 16 + 12 * n)
        docs = np.cumsum(np.frombuffer(zstandard.decompress(data[16 + 12 * n + 8 * known :]), "<i8"))
        return Batch(keys, checks, docs[:n], known_keys, docs[n:])


def _deal(keys: np.ndarray, checks: np.ndarray, docs: np.ndarray, shards: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Entries of a batch by shard. Of entries with equal key and check one of the smallest document contends."""
    if not len(keys):
        return
    order, starts = _grouped(keys, checks)
    sorted_docs, sizes = docs[order], np.diff(np.append(starts, len(keys)))
    above = sorted_docs > np.repeat(np.minimum.reduceat(sorted_docs, starts), sizes)
    group = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)[~above]
    contends, known = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    contends[order[~above][_changes(group)]] = True
    known[order] = above
    # Repeats within the smallest document itself need no entry of their own.
    by = np.nonzero(contends | known)[0]
    # Numbers of 16 bits are sorted in linear time.
    by = by[np.argsort(shards[by].astype(np.uint16 if shards.max() < 1 << 16 else np.int32), kind="stable")]
    cuts = np.nonzero(_changes(shards[by]))[0]
    for start, end in zip(cuts, np.append(cuts[1:], len(by)), strict=True):
        part = by[start:end]
        c, k = part[contends[part]], part[known[part]]
        yield int(shards[part[0]]), Batch(keys[c], checks[c], docs[c], keys[k], docs[k]).packed()


def _decide(parts: list[Batch], names: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, key and flag, as in `_decided`, of one shard's batches."""
    keys, checks, docs, known_keys, known_docs = (np.concatenate([getattr(p, x.name) for p in parts]) for x in fields(Batch))
    family = Family()
    for at in range(0, len(keys), ADDED):
        family.add(*(x[at : at + ADDED] for x in (keys, checks, docs)))
    removed = family.smallest(keys, checks) < docs
    flagged = _among(checks, family.shared_checks()) & ~removed if names and family.levels else np.zeros(len(keys), bool)
    flags = np.repeat(np.array([0, 0, 1], np.int8), [removed.sum(), len(known_docs), flagged.sum()])
    return np.concatenate([docs[removed], known_docs, docs[flagged]]), np.concatenate([keys[removed], known_keys, keys[flagged]]), flags


def _decided(batches: DataFrame, names: bool) -> DataFrame:
    """doc_id, key and flag: keys to be removed (flag 0) and, for `names`, pieces whose anchor other pieces have too (flag 1)."""

    def run(table: pa.Table) -> pa.Table:
        docs, keys, flags = _decide([Batch.unpacked(x.as_py()) for x in table.column("data")], names)
        return pa.table({"doc_id": docs, "key": keys.view(np.int64), "flag": flags})

    return batches.groupBy("shard").applyInArrow(run, "doc_id long, key long, flag byte")


#: Keys, checks, documents and shards of entries.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
_BATCH_SCHEMA = "shard int, data binary"


def _sliced(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch, a slice of AT_ONCE bytes of text or of one row at a time."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > AT_ONCE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _dealt_out(slices: Iterator[pa.RecordBatch], entries: Callable[[pa.RecordBatch], Iterator[Entries]]) -> Iterator[pa.RecordBatch]:
    """Batches for the shards, made of the entries of all slices, DEALT of them or those of one slice at a time."""

    def deal() -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        rows = list(_deal(*columns))
        return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "data"])

    held, n = [], 0
    for part in slices:
        for found in entries(part):
            held.append(found)
            n += len(found[0])
        if n >= DEALT:
            yield deal()
            n = 0
    if n:
        yield deal()


def _name_batches(texts: DataFrame, shards: int) -> DataFrame:
    def entries(batch: pa.RecordBatch) -> Iterator[Entries]:
        known = batch.filter(batch.column(0).is_valid())
        ids = known.column(0).to_numpy()
        for p in scan(_bytes(known.column(1))):
            where = ((p.anchor >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)
            yield p.name, p.anchor.astype(np.uint32), ids[p.text], where

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = lambda batch: pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        return _dealt_out((part for batch in batches for part in _sliced(batch, lengths(batch))), entries)

    return texts.mapInArrow(run, _BATCH_SCHEMA)


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _of_texts(keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Keys that differ from text to text."""
    return keys ^ _mix(_mix(numbers.astype(np.uint64) + np.uint64(1)))


def _lists(column: pa.ListArray) -> np.ndarray:
    """The keys in each text's list, made its own, in order."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    return np.sort(_of_texts(column.flatten().to_numpy().view(np.uint64), np.repeat(np.arange(len(counts)), counts)))


def _sizes(packed: pa.Array) -> list[int]:
    return [zstandard.frame_content_size(x) for x in packed.to_pylist()]


def _string_batches(flagged: DataFrame, shards: int) -> DataFrame:
    """Batches of the strings of flagged pieces. `flagged` has doc_id, packed and shared, the names of its flagged pieces."""

    def entries(batch: pa.RecordBatch) -> Iterator[Entries]:
        ids, names = batch.column(0).to_numpy(), _lists(batch.column(2))
        for p in scan([zstandard.decompress(x) for x in batch.column(1).to_pylist()]):
            piece, _, strings = p.strings(np.nonzero(_among(_of_texts(p.name, p.text), names))[0])
            where = ((_mix(p.anchor[piece] ^ strings) >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)
            yield strings, np.zeros(len(strings), np.uint32), ids[p.text[piece]], where

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _dealt_out((part for batch in batches for part in _sliced(batch, _sizes(batch.column(1)))), entries)

    return flagged.select("doc_id", "packed", "shared").mapInArrow(run, _BATCH_SCHEMA)


def _masks(texts: list[bytes], removed: pa.ListArray, shared: pa.ListArray, strings: pa.ListArray) -> list[np.ndarray]:
    """Which bytes of each text go: those of its removed pieces and of its removed strings of shared pieces."""
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    # At most LENGTH of the pieces and strings that go cover one byte.
    change = np.zeros(ends[-1] + 1, np.int8)
    some = pc.or_(*(pc.greater(pc.fill_null(pc.list_value_length(x), 0), 0) for x in (removed, strings))).to_pylist()
    removed, shared, strings = _lists(removed), _lists(shared), _lists(strings)
    for p in scan([t if any_go else b"" for t, any_go in zip(texts, some, strict=True)]):
        names, start = _of_texts(p.name, p.text), begins[p.text] + p.start
        gone = _among(names, removed)
        # No two of them begin, or end, at one place.
        change[start[gone]] += 1
        change[start[gone] + p.count[gone] + LENGTH - 1] -= 1
        if len(strings):
            piece, inner, hashes = p.strings(np.nonzero(_among(names, shared) & ~gone)[0])
            hit = _among(_of_texts(hashes, p.text[piece]), strings)
            places = (start[piece] + inner)[hit]
            change[places] += 1
            change[places + LENGTH] -= 1
    gone = np.cumsum(change[:-1], dtype=np.int8) > 0
    return [gone[begin:end] for begin, end in zip(begins, ends, strict=True)]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, the bytes that stay (null if all do), a row for each row of `docs`.

    A byte goes if a string of LENGTH bytes around it also starts in a document with a smaller doc_id. A null text
    counts as empty. Rows of one doc_id are one document's texts: none is removed for the other's sake. Documents
    without doc_id neither lose bytes nor cost others any. No rows give no rows. Other columns are ignored.
    """
    texts = id_and_text(docs)
    shards = SHARDS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = _decided(_name_batches(texts, shards), True)
    removed = F.collect_list(F.when(F.col("flag") == 0, F.col("key"))).alias("removed")
    shared = F.collect_list(F.when(F.col("flag") == 1, F.col("key"))).alias("shared")
    # A document's names, of which it has fewer than bytes.
    names = checkpoint(names.groupBy("doc_id").agg(removed, shared))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        compress = zstandard.ZstdCompressor(level=3).compress
        data = [compress(t) for t in _bytes(batch.column(1))]
        return pa.record_batch([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "packed"])

    # Both joins below read one exchange of this: they are given the same rows by the same plan.
    packed = map_batches(texts.where("doc_id IS NOT NULL"), pack, "doc_id long, packed binary").where("doc_id IS NOT NULL")
    flagged = packed.join(names.where(F.size("shared") > 0).select("doc_id", "shared"), "doc_id")
    strings = _decided(_string_batches(flagged, shards), False)
    strings = strings.groupBy("doc_id").agg(F.collect_list("key").alias("strings"))
    joined = packed.join(names.join(strings, "doc_id", "left"), "doc_id", "left")

    def masked(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        texts = [zstandard.decompress(x) for x in batch.column(1).to_pylist()]
        for text, gone in zip(texts, _masks(texts, *(batch.column(i) for i in range(2, 5))), strict=True):
            n = int(np.count_nonzero(gone))
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]) if n else 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if n else text
            rows.append((len(text), n, spans, hashlib.sha256(kept).hexdigest(), kept if n else None))
        columns = [list(c) for c in zip(*rows, strict=True)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.record_batch([batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(masked, _sliced(batch, _sizes(batch.column(1))))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    columns = ["doc_id", "packed", "removed", "shared", "strings"]
    nameless = map_batches(texts.where("doc_id IS NULL"), pack, "doc_id long, packed binary")
    nothing = [F.lit(None).cast("array<long>").alias(c) for c in columns[2:]]
    return joined.select(*columns).unionByName(nameless.select("doc_id", "packed", *nothing)).mapInArrow(run, schema)


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).drop("kept")
