"""Token ids of a corpus in binary files, and back.

Ids are ranked by how often the corpus has them, so that most ranks fit into one byte. A rank takes one to four
bytes; its length is two bits of a control byte. Control bytes stand apart from the data bytes, four ranks to a
control byte, so a block is decoded by looking its control bytes up in a table of 256 masks, all ranks at once.

The files are a data source of Spark's, `token_ids`: sorted parts are written as they come, block by block, and only
the files of tasks that succeeded are put into the manifest. So a task that is run again leaves nothing double.

Format. ranks.bin: ids in rank order as little-endian unsigned 32-bit integers. *.ids: MAGIC, then blocks of whole
documents, each a head of four 64-bit integers (documents, ids, data bytes, crc32 of what follows) and doc_ids
(64-bit), a byte for each document that tells whether it has a doc_id, numbers of ids (64-bit), control bytes and
data bytes. manifest.json: for each file its name, documents, ids, and ids before it.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from deedmill.llm.common import checkpoint, id_and_text, map_batches, shared_folder
from deedmill.llm.tokencount import LONG_TEXT, LONGEST, Lengths

MAGIC = b"DMIDS001"
#: Ids of a block and of a file; a block or file ends with the document that reaches them.
BLOCK_IDS, FILE_IDS = 1 << 18, 1 << 26
#: Pre-tokens that a worker keeps with their ids; a full cache is emptied.
CACHE_SIZE = 1_000_000
#: The id that ends each document.
END = 0
_HEAD = np.dtype("<i8")
ROWS = "doc_id long, start long, n_tokens long, ids binary"

# The characters that byte-level vocabularies write bytes as. Printable ones stand for themselves.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARACTERS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


# The split pattern once more, for texts of no other characters than these, as a pattern that is found faster. Letters
# come first, which changes nothing: nothing else begins with one.
_OTHER = re.compile("[^\x00-\u017f\u2010-\u2027]")
_LETTERS, _NUMBERS, _SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PLAIN = re.compile(
    f" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


class Encoder(dict):
    """Ids of whole texts as the tokenizers library gives them, pre-token by pre-token; as bytes, `width` for each id."""

    def __init__(self, path: str, width: int):
        super().__init__()
        checked = Lengths(path, {})
        self.tokenizer, self.slow_pieces, self.width = checked.tokenizer, checked.pieces, width
        self.merged = self.tokenizer.model.tokenize
        self.special = {t.content: self.packed([i]) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        longest_first = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(longest_first)})").split if self.special else lambda text: [text]

    def pieces(self, part: str) -> Iterable[str]:
        return self.slow_pieces(part) if len(part) > LONG_TEXT or _OTHER.search(part) else _PLAIN.findall(part)

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.packed([t.id for t in self.merged(piece.encode().decode("latin-1").translate(_CHARACTERS))])
        if len(piece) <= LONGEST:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        # Parts at odd places are added tokens.
        parts = (self.special[p] if i % 2 else b"".join(map(self.__getitem__, self.pieces(p))) for i, p in enumerate(self.cut(text)))
        return b"".join(parts)


_encoders: dict[tuple[str, int], Encoder] = {}


def _encoder(path: str, width: int) -> Encoder:
    if (path, width) not in _encoders:
        _encoders.clear()
        _encoders[path, width] = Encoder(path, width)
    return _encoders[path, width]


def id_width(path: str) -> int:
    """Bytes that any id of a vocabulary file fits into: two or four."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    largest = max([*described["model"]["vocab"].values(), *(t["id"] for t in described["added_tokens"])])
    return 2 if largest < 1 << 16 else 4


def _squeezed(ids: bytes, width: int, compress: Callable[[bytes], bytes]) -> bytes:
    """Ids compressed, their first bytes together, then their second ones and so on."""
    return compress(np.frombuffer(ids, np.uint8).reshape(-1, width).T.tobytes())


def _restored(squeezed: bytes, width: int) -> bytes:
    return np.frombuffer(zstandard.decompress(squeezed), np.uint8).reshape(width, -1).T.tobytes()


def encoded(docs: DataFrame, path: str, width: int) -> DataFrame:
    """doc_id and packed, the squeezed ids of the whole text with the end id, for each row of `docs`; written to the shared folder.

    A null text is empty: its only id is the end id. tie orders rows of one doc_id.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = _encoder(path, width)
        end, compress = encoder.packed([END]), zstandard.ZstdCompressor(1).compress
        packed = [_squeezed(encoder.encode(text or "") + end, width, compress) for text in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    rows = map_batches(id_and_text(docs), run, "doc_id long, packed binary")
    return checkpoint(rows.withColumn("tie", F.xxhash64("packed")))


def ranking(rows: DataFrame, width: int) -> np.ndarray:
    """Ids that occur in `rows` (as encoded gives them), the most frequent first; ties to the smaller id.

    What reaches the driver is bounded by the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(_restored(ids, width) for ids in batch.column(0).to_pylist()), f"<u{width}"), minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
        ids = np.nonzero(counts)[0]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(counts[ids], pa.int64())], ["id", "n"])

    counted = rows.select("packed").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = np.array([tuple(r) for r in counted.collect()], np.int64).reshape(-1, 2)
    return found[np.lexsort((found[:, 0], -found[:, 1])), 0].astype("<u4")


_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)
#: For each control byte, which of the four bytes of each of its four ranks are in the data.
_MASKS = (np.arange(4) < _LENGTHS[:, :, None]).reshape(256, 16)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    codes = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]]
    fours = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    fours[: len(codes)] = codes
    fours = fours.reshape(-1, 4)
    return (fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6).tobytes(), data.tobytes()


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n ranks of control and data bytes."""
    mask = _MASKS[control].reshape(-1, 4)[:n]
    ranks = np.zeros((n, 4), np.uint8)
    ranks[mask] = data
    return ranks.view("<u4").ravel()


def _at(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path in it."""
    parts = urlsplit(uri)
    return (pafs.LocalFileSystem(), parts.path) if parts.scheme in ("", "file") else pafs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, data: bytes) -> None:
    files, path = _at(uri)
    with files.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def _get(uri: str, name: str) -> bytes:
    files, path = _at(uri)
    with files.open_input_stream(f"{path}/{name}") as data:
        return data.read()


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, in order: part, number, name, documents and ids."""

    files: list[tuple[int, int, str, int, int]]


class _Block:
    """Documents that are to be written together."""

    def __init__(self, width: int) -> None:
        self.doc_ids: list[int | None] = []
        self.ids: list[bytes] = []
        self.width, self.n = width, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.n += len(ids) // self.width

    def packed(self, rank_of: np.ndarray) -> bytes:
        control, data = pack_ranks(rank_of[np.frombuffer(b"".join(self.ids), f"<u{self.width}")])
        named = np.array([d is not None for d in self.doc_ids], np.uint8)
        sizes = np.array([len(i) // self.width for i in self.ids], "<i8")
        body = b"".join([np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(), named.tobytes(), sizes.tobytes(), control, data])
        return np.array([len(sizes), self.n, len(data), zlib.crc32(body)], _HEAD).tobytes() + body


def _unpacked(head: np.ndarray, body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, numbers of ids, and ranks of a block."""
    docs, n, data, crc = head.tolist()
    if zlib.crc32(body) != crc:
        raise ValueError("a block of token ids is damaged")
    doc_ids = np.frombuffer(body, "<i8", docs)
    named = np.frombuffer(body, np.uint8, docs, 8 * docs)
    sizes = np.frombuffer(body, "<i8", docs, 9 * docs)
    control = np.frombuffer(body, np.uint8, -(-n // 4), 17 * docs)
    return [d if k else None for d, k in zip(doc_ids.tolist(), named, strict=True)], sizes, unpack_ranks(control, np.frombuffer(body, np.uint8, data, 17 * docs + len(control)), n)


class TokenIdWriter(DataSourceArrowWriter):
    """Rows of doc_id and packed, already in order, to files."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.width = options["path"], int(options["width"])
        self.block_ids, self.file_ids = int(options.get("block_ids", BLOCK_IDS)), int(options.get("file_ids", FILE_IDS))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        ids = np.frombuffer(_get(self.folder, "ranks.bin"), "<u4")
        rank_of = np.zeros(int(ids.max(initial=0)) + 1, np.uint32)
        rank_of[ids] = np.arange(len(ids))
        part, tag = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, folder = _at(self.folder)
        written, out, block = [], None, _Block(self.width)

        def flush() -> None:
            nonlocal out, block
            if not block.n:
                return
            if out is None:
                written.append([part, len(written), f"part-{part:06d}-{len(written):04d}-{tag}.ids", 0, 0])
                out = files.open_output_stream(f"{folder}/{written[-1][2]}")
                out.write(MAGIC)
            out.write(block.packed(rank_of))
            written[-1][3] += len(block.ids)
            written[-1][4] += block.n
            block = _Block(self.width)
            if written[-1][4] >= self.file_ids:
                out.close()
                out = None

        for batch in iterator:
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                block.add(doc_id, _restored(packed, self.width))
                if block.n >= self.block_ids:
                    flush()
        flush()
        if out is not None:
            out.close()
        return Written([tuple(w) for w in written])

    def commit(self, messages: list[Written | None]) -> None:
        start, entries = 0, []
        for _, _, name, docs, ids in sorted(f for m in messages if m for f in m.files):
            entries.append({"name": name, "docs": docs, "ids": ids, "start": start})
            start += ids
        _put(self.folder, "manifest.json", json.dumps(entries).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = _at(self.folder)
        for _, _, name, _, _ in (f for m in messages if m for f in m.files):
            files.delete_file(f"{folder}/{name}")


@dataclass
class TokenIdFile(InputPartition):
    name: str
    start: int


class TokenIdReader(DataSourceReader):
    """A row for each document of the files in the manifest; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]

    def partitions(self) -> list[TokenIdFile]:
        return [TokenIdFile(e["name"], e["start"]) for e in json.loads(_get(self.folder, "manifest.json"))]

    def read(self, partition: TokenIdFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            # Without partitions, Spark reads once with none.
            return
        ids, start = np.frombuffer(_get(self.folder, "ranks.bin"), "<u4"), partition.start
        files, folder = _at(self.folder)
        with files.open_input_stream(f"{folder}/{partition.name}") as data:
            if data.read(len(MAGIC)) != MAGIC:
                raise ValueError(f"{partition.name} holds no token ids")
            while head := data.read(4 * _HEAD.itemsize):
                head = np.frombuffer(head, _HEAD)
                docs, n, size, _ = head.tolist()
                doc_ids, sizes, ranks = _unpacked(head, data.read(17 * docs + -(-n // 4) + size))
                ends = np.cumsum(sizes)
                places = pa.py_buffer(np.append(0, 4 * ends).astype(np.int64))
                found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), docs, [None, places, pa.py_buffer(ids[ranks])])
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + ends - sizes), pa.array(sizes), found.cast(pa.binary())]
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids"])
                start += n


class TokenIds(DataSource):
    """The format `token_ids`; its path is a folder in which ranks.bin already is."""

    @classmethod
    def name(cls) -> str:
        return "token_ids"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: StructType) -> TokenIdReader:
        return TokenIdReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> TokenIdWriter:
        return TokenIdWriter(self.options)


def write(docs: DataFrame, path: str, folder: str, **sizes: int) -> None:
    """Write the ids of all texts of `docs` to `folder`, in ascending order of doc_id, those without one first.

    `path` names a byte-level vocabulary file of the tokenizers library, `folder` is a new one that all executors
    share. Rows of one doc_id are written one after the other, in an order that hangs on their ids alone. No rows
    give a manifest without files. Other columns are ignored.
    """
    width = id_width(path)
    rows = encoded(docs, path, width)
    files, place = _at(folder)
    files.create_dir(place, recursive=True)
    _put(folder, "ranks.bin", ranking(rows, width).tobytes())
    docs.sparkSession.dataSource.register(TokenIds)
    parts = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "packed").select("doc_id", "packed")
    parts.write.format("token_ids").mode("append").options(width=width, **sizes).save(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids of each document in `folder`."""
    spark.dataSource.register(TokenIds)
    return spark.read.format("token_ids").load(folder)


def query(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, path, folder)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
