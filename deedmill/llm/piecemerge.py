"""Encoding and decoding with a merge-type SentencePiece model by a table of last tokens.

The encoding of every prefix of a text ends in one certain token. An automaton over all pieces finds, at each
position, the pieces that end there; the last token is the one whose predecessor, the last token of the prefix
before it, forms a stable pair with it: merging the two pieces' text from its characters gives just these two.
The ids are then read off backwards. The time is linear in the text, whatever its words look like.

Texts are first cut before every run of blanks, across which no piece of a supported model reaches, and the ids
of short stretches are kept in a worker's cache.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deedmill.llm.common import id_and_text, map_batches

BLANK = "▁"
#: Entries of a worker's cache of stretches, and the longest stretch kept; entries of its cache of pairs. A full cache is emptied.
CACHE_SIZE, LONGEST = 600_000, 64
PAIRS_SIZE = 300_000
UNSET, UNKNOWN = -1, -2

_STRETCHES = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+").findall


class Pieces(dict):
    """A merge-type model. As a dict: stretch of text to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(library.get_piece_size())
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.score = {
            library.id_to_piece(i): library.get_score(i)
            for i in ids
            if not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i) or library.is_byte(i))
        }
        self.id = {p: library.piece_to_id(p) for p in self.score}
        self.byte_id = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(library.is_byte(i) for i in self.byte_id):
            raise ValueError(f"{path}: a model with byte fallback is needed")
        if any(BLANK in p[1:] and p.strip(BLANK) for p in self.score):
            raise ValueError(f"{path}: has pieces that reach across blanks")
        if library.decode(library.encode(" a  ﬁ ")) != " a  ﬁ " or not library.encode("a", out_type=str)[0].startswith(BLANK):
            raise ValueError(f"{path}: a model that only adds a blank before a text is needed")
        self.surface = [b""] * len(ids)
        for piece, i in self.id.items():
            self.surface[i] = piece.replace(BLANK, " ").encode()
        for byte, i in enumerate(self.byte_id):
            self.surface[i] = bytes([byte])
        self.length = [0] * len(ids)
        for piece, i in self.id.items():
            self.length[i] = len(piece)
        self.piece = [library.id_to_piece(i) for i in ids]
        self.stable: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id.items():
            if piece == BLANK or piece.strip(BLANK) and (len(piece) == 1 or self.merged(piece) == [piece]):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """Merge the characters of `text` by the definition: the best score first, then the leftmost."""
        symbols, n = list(text), len(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if 0 <= left and after[left] < n and (s := self.score.get(whole := symbols[left] + symbols[after[left]])) is not None:
                heapq.heappush(waiting, (-s, left, whole))

        for i in range(n):
            offer(i)
        while waiting:
            _, left, whole = heapq.heappop(waiting)
            if not symbols[left] or after[left] >= n or symbols[left] + symbols[after[left]] != whole:
                continue
            right = after[left]
            symbols[left], symbols[right] = whole, ""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            offer(before[left])
            offer(left)
        return [s for s in symbols if s]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when they meet."""
        if len(self.stable) >= PAIRS_SIZE:
            self.stable.clear()
        pair = [self.piece[left], self.piece[right]]
        known = self.stable[left << 32 | right] = self.merged("".join(pair)) == pair
        return known

    def word_ids(self, word: str) -> list[int]:
        """Ids of a stretch with one blank at most, its first character."""
        last = [UNSET] * (len(word) + 1)
        stable, fits = self.stable.get, self.fits
        for end, (piece, length) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            if start := end - length:
                if last[start] == UNSET:
                    self._unknown(last, start)
                left = last[start]
                if left >= 0:
                    known = stable(left << 32 | piece)
                    if not (fits(left, piece) if known is None else known):
                        continue
            last[end] = piece
        at, found = len(word), []
        if last[at] == UNSET:
            self._unknown(last, at)
        while at:
            piece = last[at]
            if piece >= 0:
                found.append(piece)
                at -= self.length[piece]
            else:
                at -= 1
                found += [self.byte_id[b] for b in reversed(word[at].encode())]
        found.reverse()
        return found

    @staticmethod
    def _unknown(last: list[int], end: int) -> None:
        """At positions up to `end` where no piece ends, a character ends that is in no piece."""
        while end and last[end] == UNSET:
            last[end] = UNKNOWN
            end -= 1

    def __missing__(self, stretch: str) -> bytes:
        word = stretch.lstrip(BLANK)
        blanks = len(stretch) - len(word)
        if not word:
            ids = self.blank_ids(blanks)
        elif not blanks:
            ids = self.word_ids(word)
        else:
            # Pieces of blanks alone have lower scores than all others, so a word takes its blank first.
            ids = self.word_ids(BLANK + word)
            if blanks > 1:
                free = ids[0] == self.id[BLANK]
                ids = self.blank_ids(blanks - (not free)) + ids[free:]
        packed = array("I", ids)
        if sys.byteorder != "little":
            packed.byteswap()
        packed = packed.tobytes()
        if len(stretch) <= LONGEST:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[stretch] = packed
        return packed

    def blank_ids(self, n: int) -> list[int]:
        return [self.id[p] for p in self.blanks(n)]

    def blanks(self, n: int) -> list[str]:
        """A run of blanks merges from the left, up to the longest piece of blanks that pairs can make."""
        if n <= 64:
            return self.merged(BLANK * n)
        unit = self.merged(BLANK * 64)
        size = len(unit[0])
        if any(u != unit[0] for u in unit[: 64 // size]):
            return self.merged(BLANK * n)
        whole = n // size - 1
        return [unit[0]] * whole + self.merged(BLANK * (n - whole * size))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers, with begin and end."""
        ends = [np.array([i], "<u4").tobytes() for i in (self.begin, self.end)]
        if not text:
            return b"".join(ends)
        return ends[0] + b"".join(map(self.__getitem__, _STRETCHES(BLANK + text.replace(" ", BLANK)))) + ends[1]

    def decode(self, packed: bytes) -> str:
        """The text of ids: their pieces joined, without the blank that stands before every text."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.surface.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


_open: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's model, which lasts from task to task."""
    if path not in _open:
        _open[path] = Pieces(path)
    return _open[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers with begin and end) and decoded, the text they stand for.

    `path` names a merge-type SentencePiece model with byte fallback, readable on every executor. A null text
    counts as empty and has begin and end alone. Null and repeated doc_ids are passed on, a row for each row of
    `docs`; no rows give no rows. Other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = pieces(path)
        ids = [model.encode(t) for t in batch.column(1).to_pylist()]
        decoded = [model.decode(x) for x in ids]
        return pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return map_batches(id_and_text(docs), run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str, *kept: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what encode_documents gives, hashed where it is made, and columns to be kept."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = pieces(path)
        ids = [model.encode(t) for t in batch.column(1).to_pylist()]
        columns = [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
            pa.array([hashlib.sha256(model.decode(x).encode()).hexdigest() for x in ids]),
        ]
        return pa.record_batch([batch.column(0), *columns, *batch.columns[2:]], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *kept]
    schema = StructType.fromDDL("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    texts = id_and_text(docs) if not kept else docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *kept)
    return map_batches(texts, run, StructType([*schema, *(docs.schema[c] for c in kept)]))
