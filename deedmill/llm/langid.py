"""Language identification by averaged embeddings of hashed letter sequences and a linear softmax.

A text is lower-cased and everything but letters becomes a blank. Its features are the hashed sequences of two to
four bytes, which thus know where words begin and end. Their embeddings are averaged and a linear softmax tells
the language. Embeddings and softmax are trained together by stochastic gradient descent on a bounded sample;
on a part of it that training has not seen, a temperature and the rejection threshold are set.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deedmill.llm.common import map_batches

BUCKETS, DIMENSIONS, GRAMS = 1 << 14, 16, (2, 3, 4)
#: Bounds of the training sample: texts of each language, and of all languages together; shares in which it is chosen.
PER_LANGUAGE, IN_ALL, SHARES = 600, 6000, 1024
#: Leading bits of the hash by which a language's first texts are cut out before they are sorted.
PART_BITS = 12
#: Every so-manieth text of the sample is kept for calibration.
CALIBRATE = 5
EPOCHS, RATE, SEED = 8, 0.5, 7
#: Accuracy that accepted texts of the calibration part shall reach.
TARGET = 0.995
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_REST = re.compile(r"[\W\d_]+")


def features(text: str | None) -> np.ndarray | None:
    """The bucket of every letter sequence of a whole text; None if it has no letter."""
    if not text or not _LETTER.search(text):
        return None
    raw = np.frombuffer(f" {_REST.sub(' ', text.lower()).strip()} ".encode(), np.uint8).astype(np.uint32)
    found, running = [], raw
    for n in range(2, max(GRAMS) + 1):
        running = (running[:-1] * np.uint32(0x01000193)) ^ (raw[n - 1 :] + np.uint32(n << 8))
        if n in GRAMS:
            mixed = running * np.uint32(0x9E3779B1)
            found.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """What training gives. `logits` holds, for each bucket, its embedding times the softmax weights."""

    languages: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, text: str | None) -> np.ndarray | None:
        if not self.languages or (buckets := features(text)) is None or not len(buckets):
            return None
        counts = np.bincount(buckets, minlength=BUCKETS)
        z = (counts @ self.logits / len(buckets) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """`bags` are (language, buckets, counts) of the sample's texts."""
    languages = tuple(sorted({b[0] for b in bags}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    label = {name: i for i, name in enumerate(languages)}
    random = np.random.default_rng(SEED)
    embedding = random.normal(0, 1 / np.sqrt(DIMENSIONS), (BUCKETS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    data = [(label[name], idx, counts / counts.sum()) for name, idx, counts in bags]
    learn = [x for i, x in enumerate(data) if i % CALIBRATE] or data
    check = [x for i, x in enumerate(data) if not i % CALIBRATE]
    steps, step = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(learn)):
            y, idx, share = learn[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ embedding[idx]
            slope = _softmax(hidden @ weights + bias)
            slope[y] -= 1
            back = weights @ slope
            weights -= rate * np.outer(hidden, slope)
            bias -= rate * slope
            # A text's share of a bucket is small, so embeddings take steps that make up for the average.
            embedding[idx] -= (rate * 10) * share[:, None] * back[None, :]
    logits = embedding @ weights
    z = np.array([share @ logits[idx] for _, idx, share in check]) + bias
    y = np.array([x[0] for x in check])
    # As if one text more of each language had been told wrongly, so that few or easy texts give no certainty.
    wrong = len(languages) / (len(y) + len(languages))
    aim = np.full(z.shape, wrong / len(languages))
    aim[np.arange(len(y)), y] += 1 - wrong
    loss = lambda t: -(aim * np.log(_softmax(z / t) + 1e-12)).sum(axis=1).mean()
    temperature = float(min(np.geomspace(0.02, 5, 60), key=loss))
    p = _softmax(z / temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-best, kind="stable")
    accuracy = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.nonzero(accuracy >= TARGET)[0]
    threshold = 0.0 if len(good) and good[-1] == len(order) - 1 else float(best[order[good[-1]]]) if len(good) else 1.0
    return Model(languages, logits, bias, temperature, min(max(threshold, 1.25 / len(languages)), 0.9))


def fit(docs: DataFrame) -> Model:
    """Train on at most PER_LANGUAGE whole texts a language and IN_ALL in all, those first in order of a hash of the id.

    Only texts with a language whose crc32 of the id, modulo 4, is not 2 take part. What reaches the driver of a
    text is its bag of hashed features, BUCKETS entries at most.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    known = known.where("lang is not null and doc_id is not null and not (crc32(cast(doc_id as string)) % 4 <=> 2)").distinct()
    hashed = F.xxhash64("doc_id", "lang")
    known = known.withColumn("hashed", hashed).withColumn("part", F.shiftright("hashed", 64 - PART_BITS))
    # First within each of many shares of a language, so that no task gets all of its texts.
    share = F.pmod(F.xxhash64("lang", "doc_id"), F.lit(SHARES))
    rank = F.row_number().over(Window.partitionBy("lang", share).orderBy("hashed", "doc_id"))
    known = known.withColumn("rank", rank).where(F.col("rank") <= PER_LANGUAGE)
    # Then parts of the hash's range, as many as are needed: a language has two to the PART_BITS at most.
    parts = known.groupBy("lang", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("before", before).where(f"coalesce(before, 0) < {PER_LANGUAGE}")
    known = known.join(parts.select("lang", "part"), ["lang", "part"], "left_semi")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hashed", "doc_id"))
    known = known.withColumn("rank", rank).where(F.col("rank") <= PER_LANGUAGE)
    chosen = known.orderBy("rank", "hashed", "doc_id").limit(IN_ALL)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    # The chosen side has IN_ALL rows at most.
    texts = texts.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc_id, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (buckets := features(text)) is not None and len(buckets):
                idx, counts = np.unique(buckets, return_counts=True)
                rows.append((doc_id, lang, idx.astype("<u2").tobytes(), counts.astype("<f4").tobytes()))
        columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], []]
        types = [pa.int64(), pa.string(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "lang", "idx", "counts"])

    bags = map_batches(texts.select("doc_id", "lang", "text"), run, "doc_id long, lang string, idx binary, counts binary")
    rows = bags.orderBy(F.xxhash64("doc_id", "lang"), "doc_id", F.xxhash64("idx", "counts")).limit(IN_ALL).collect()
    return train([(r.lang, np.frombuffer(r.idx, "<u2"), np.frombuffer(r.counts, "<f4")) for r in rows])


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected, a row for each row of `docs`; trains on `docs` if no model is given.

    A text that is null or has no letter is `und` with score 0 and rejected, and so is every text if nothing could be
    learned from. Others get the best language with its calibrated probability and are rejected below the
    threshold. A null doc_id is passed on and never held out nor trained on. No rows give no rows. Only doc_id and
    text decide on a prediction.
    """
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        held = [i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in batch.column(0).to_pylist()]
        found = [model.scores(t) for t in batch.column(1).to_pylist()]
        best = [UNKNOWN if p is None else model.languages[int(p.argmax())] for p in found]
        score = [0.0 if p is None else float(p.max()) for p in found]
        rejected = [p is None or s < model.threshold for p, s in zip(found, score, strict=True)]
        columns = [pa.array(held), pa.array(best, pa.string()), pa.array(score), pa.array(rejected)]
        return pa.record_batch([batch.column(0), *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose text is not rejected; all columns."""
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        best = (model.scores(t) for t in batch.column(place).to_pylist())
        return batch.filter(pa.array([p is not None and p.max() >= model.threshold for p in best], pa.bool_()))

    return map_batches(docs, run, docs.schema)
