"""Token counts of a byte-level BPE vocabulary without encoding most of the text.

A text's count is the sum of the counts of its pre-tokens. The lengths of frequent pre-tokens sit in a table of
bounded size that every task gets; the rest are encoded once by each worker and kept in its cache. Pre-token
occurrences are never shuffled: for the choice of the table, each task counts its own pre-tokens in bounded
memory and hands on only its most frequent ones.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deedmill.llm.common import id_and_text, map_batches

#: Entries of the table that every task gets.
TABLE_SIZE = 65_536
#: Pre-tokens that a task counts at once and hands on; longer ones than LONGEST are left to the workers.
COUNTED, HANDED_ON, LONGEST = 200_000, 16_384, 48
#: Entries of a worker's cache; a full cache is emptied.
CACHE_SIZE = 400_000
LONG_TEXT = 1 << 22
LIMIT = 512

# Fixed value: the split pattern of byte-level BPE.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Lengths(dict):
    """Pre-token to number of tokens: the table's entries, then the worker's own."""

    def __init__(self, path: str, table: dict[str, int]):
        super().__init__(table)
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        kind, added = description["pre_tokenizer"] or {}, description["added_tokens"]
        if kind.get("type") != "ByteLevel" or not kind.get("use_regex") or kind.get("add_prefix_space") or description["normalizer"]:
            raise ValueError(f"{path}: only plain byte-level vocabularies are supported")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path}: only plain added tokens are supported")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.find, self.find_one_by_one = regex.compile(SPLIT).findall, regex.compile(SPLIT).finditer
        special = sorted((regex.escape(t["content"]) for t in added), key=len, reverse=True)
        self.cut = regex.compile("|".join(special)).split if special else lambda text: [text]
        self.table_size, self.longest = len(self) + CACHE_SIZE, LONGEST
        self.table = table

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= self.longest:
            if len(self) >= self.table_size:
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n

    def pieces(self, part: str) -> Iterable[str]:
        """Pre-tokens of a text without added tokens; those of a very long one, one by one."""
        return self.find(part) if len(part) <= LONG_TEXT else (m[0] for m in self.find_one_by_one(part))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.cut(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts)


_open: dict[str, Lengths] = {}


def lengths(path: str, key: str = "", table: dict[str, int] | None = None) -> Lengths:
    """The worker's counter for a vocabulary and table, which lasts from task to task."""
    if (found := _open.get(path + key)) is None:
        _open.clear()
        found = _open[path + key] = Lengths(path, table or {})
    return found


def frequent_pieces(texts: DataFrame, path: str, size: int = TABLE_SIZE) -> dict[str, int]:
    """The number of tokens of the most frequent pre-tokens of all texts, `size` at most.

    Each task hands on the HANDED_ON most frequent of its own pre-tokens. What a task's bounded counter forgets
    changes only what the table holds, never a result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = Counter(), lengths(path)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counter.update(split.pieces(text or ""))
                if len(counter) > COUNTED:
                    counter = Counter(dict(counter.most_common(COUNTED // 2)))
        top = [(p, n, split[p]) for p, n in counter.most_common(HANDED_ON) if len(p) <= LONGEST and n > 1]
        columns = [list(c) for c in zip(*top, strict=True)] or [[], [], []]
        types = [pa.string(), pa.int64(), pa.int32()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["piece", "n", "tokens"])

    counted = texts.select("text").mapInArrow(run, "piece string, n long, tokens int")
    totals = counted.groupBy("piece").agg(F.sum("n").alias("n"), F.first("tokens").alias("tokens"))
    best = totals.orderBy(F.desc("n"), "piece").limit(size).select("piece", "tokens").collect()
    return dict(map(tuple, best))


def count_tokens(docs: DataFrame, path: str, size: int = TABLE_SIZE, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, a row for each row of `docs`.

    `path` names a byte-level vocabulary file of the tokenizers library, readable on every executor. Strings of
    added tokens inside a text count as that token, as in the library. A null text counts as empty: no bytes, no
    tokens. Null and repeated doc_ids are passed on. No rows give no rows. Other columns are ignored.
    """
    texts = id_and_text(docs)
    table = frequent_pieces(texts, path, size)
    shared, key = docs.sparkSession.sparkContext.broadcast(table), f"#{hash(frozenset(table.items()))}"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = lengths(path, key, shared.value).count
        tokens = [count(t) for t in batch.column(1).to_pylist()]
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
        over = pa.array([n > limit for n in tokens], pa.bool_())
        return pa.record_batch([batch.column(0), sizes, pa.array(tokens, pa.int64()), over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(texts, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
