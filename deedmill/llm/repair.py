"""Repair of the structure of conversations by cheapest edits, found once for all conversations that end alike.

A conversation is told by its signature, a symbol for each row: the role's initial and the row's fault. What repair
costs from a row on hangs on the rest of the signature and on the state of the grammar `(s?(ua)+)?` alone. So the
signatures of all conversations make up one automaton that shares their suffixes: a node is a suffix, and for each
grammar state it knows the cost to go and the least audit, the edits' initials. Sorted from their last symbol,
signatures of one suffix stand together in a task, wherever they come from; each node is made once there, and only
the path of the current signature is held.

Long conversations are cut into segments of SEGMENT rows at most. A segment's node gives cost and audit for each
pair of states at its two edges; these are put together from the last segment to the first. A least audit for equal
cost can be chosen edge by edge: of two edit strings for the same rows, one that begins with the other costs more.

Rows are dealt by sorted ranges until segments are cut, so a conversation of any share of the rows is spread over
tasks. Only its segments, and the texts that its SHA-256 takes in order, are streamed by one task in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedmill.llm.common import checkpoint

#: Rows of a segment at most.
SEGMENT = 128
#: Damage is chosen by the crc32 of `conv_id:turn`, modulo this.
KINDS = 20
BLANKS, ENDS = " \t\n\v\f\r", ".!?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Symbol of a row that must go; others are s, u, a, or x for any other role, as capitals if the text is truncated.
GONE = "-"
#: Grammar states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. What user or assistant, whichever may come next, leads to.
STEP = (2, 2, 3, 2)
_STATES = range(4)
#: Cost and audit at the end of a conversation, by state: a turn that lacks its answer gets one.
_END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
_LEGAL = {"su", "ua", "au"}

Way = tuple[int, str] | None
Node = list[list[Way]]


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of each row after damage; a dropped row has no copies. Nulls count as one blank, but turns stay null."""
    conv_id, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat(*(F.coalesce(c.cast("string"), F.lit(" ")) if i != 1 else F.lit(":") for i, c in enumerate((conv_id, None, turn))))
    kind = F.crc32(key.cast("binary")) % KINDS
    return turns.select(
        conv_id.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """`rows` with name and digest, by which rows of one turn are ordered, blank and truncated."""
    shown = F.rtrim("text", F.lit(BLANKS))
    return rows.select(
        "*",
        F.substring("role", 1, 32).alias("name"),
        F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        (shown == "").alias("blank"),
        (~F.right(shown, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )


def _classified(rows: DataFrame) -> DataFrame:
    """Rows that differ, with n, how many there are, and first, whether no earlier row of the conversation has this role and text.

    Counts and minima are taken with partial aggregation, and joined on keys that one row has.
    """
    key = ["conv_id", "turn", "name", "digest"]
    single = rows.where("copies > 0").groupBy(*key).agg(
        F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated")
    )
    single = checkpoint(single)
    said = single.groupBy("conv_id", "name", "digest").agg(F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("least"))
    said = said.select("conv_id", F.when(~F.col("unnumbered"), F.col("least")).alias("turn"), "name", "digest", F.lit(True).alias("first"))
    said = said.select(*(F.col(c).alias(f"_{c}") for c in key), "first")
    met = single.join(said, [single[c].eqNullSafe(said[f"_{c}"]) for c in key], "left")
    initial = F.substring(single["name"], 1, 1).alias("initial")
    return met.select(*key, "n", initial, "blank", "truncated", F.coalesce("first", F.lit(False)).alias("first"))


def _counts(rows: DataFrame, classified: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate and truncated of every conversation, those without rows included."""
    blank, first = F.col("blank"), F.col("first")
    none, n = F.lit(0).cast("long"), F.col("n")
    faults = classified.select(
        "conv_id", "turn",
        F.when(blank, n).otherwise(none).alias("blank"),
        F.when(blank, none).otherwise(n - first.cast("long")).alias("duplicate"),
        (first & F.col("truncated") & ~blank).cast("long").alias("truncated"),
    )
    every = rows.select("conv_id", F.lit(None).cast("long").alias("turn"), none.alias("blank"), none.alias("duplicate"), none.alias("truncated"))
    names = ["blank", "duplicate", "truncated"]
    by_turn = faults.union(every).groupBy("conv_id", "turn").agg(*(F.sum(c).alias(c) for c in names))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), none).alias("gaps")
    return by_turn.groupBy("conv_id").agg(gaps, *(F.sum(c).alias(c) for c in names))


def _runs(rows: Iterable[dict], size: int) -> Iterator[dict]:
    """Segments of sorted rows: the first row's place, the signature, illegal pairs within, and the initials at both edges."""
    segment = None

    def opened(row: dict, at: int) -> dict:
        place = {c: row[c] for c in ("conv_id", "turn", "name", "digest")}
        return place | {"copy": at, "signature": "", "illegal": 0, "head": row["initial"], "tail": None}

    for row in rows:
        if segment and segment["conv_id"] != row["conv_id"]:
            yield segment
            segment = None
        symbol = row["initial"] if row["initial"] in ("s", "u", "a") else "x"
        symbol = symbol.upper() if row["truncated"] else symbol
        at = 0
        while at < row["n"]:
            if segment and len(segment["signature"]) >= size:
                yield segment
                segment = None
            segment = segment or opened(row, at)
            more = min(row["n"] - at, size - len(segment["signature"]))
            kept = symbol if at == 0 and row["first"] and not row["blank"] else ""
            segment["illegal"] += segment["tail"] is not None and segment["tail"] + row["initial"] not in _LEGAL
            segment["illegal"] += (more - 1) * (2 * row["initial"] not in _LEGAL)
            segment["signature"] += kept + GONE * (more - len(kept))
            segment["tail"] = row["initial"]
            at += more
    if segment:
        yield segment


_PLACE = "conv_id long, turn long, name string, digest binary, copy long"
_SEGMENT = f"{_PLACE}, signature string, illegal long, head string, tail string"


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield dict(zip(names, row, strict=True))


def _batched(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _segments(classified: DataFrame, size: int) -> DataFrame:
    order = ["conv_id", "turn", "name", "digest"]
    text, long = pa.string(), pa.int64()
    schema = pa.schema([("conv_id", long), ("turn", long), ("name", text), ("digest", pa.binary()), ("copy", long), ("signature", text), ("illegal", long), ("head", text), ("tail", text)])
    return (
        classified.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(lambda batches: _batched(_runs(_dicts(batches), size), schema), _SEGMENT)
    )


def _better(a: Way, b: Way) -> Way:
    return b if a is None else a if b is None else min(a, b)


def _edited(way: Way, cost: int, letter: str) -> Way:
    return way and (way[0] + cost, letter + way[1])


def node(symbol: str, rest: Node) -> Node:
    """The node of a suffix that begins with `symbol` and goes on with the node `rest`.

    node[q][e] is the least cost, and of these the least audit, that leads from grammar state q to state e.
    """
    initial, late = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    found: Node = []
    for q in _STATES:
        ways = [_edited(w, DELETE, "D") for w in rest[q]]
        if symbol != GONE:
            edits = [(REROLE + late, "R", STEP[q])]
            if initial == ("a" if STEP[q] == 3 else "u"):
                edits.append((KEEP + late, "K", STEP[q]))
            elif initial == "s" and q == 0:
                edits.append((KEEP + late, "K", 1))
            for cost, letter, to in edits:
                ways = [_better(w, _edited(v, cost, letter)) for w, v in zip(ways, rest[to], strict=True)]
        found.append(ways)
    # Two insertions before one row at most: a third would come back to a state that was there.
    for _ in range(2):
        found = [[_better(w, _edited(v, INSERT, "I")) for w, v in zip(found[q], found[STEP[q]], strict=True)] for q in _STATES]
    return found


_LEAF: Node = [[(0, "") if e == q else None for e in _STATES] for q in _STATES]


def automaton(signatures: Iterable[str]) -> Iterator[Node]:
    """The node of each signature. Those that share a suffix share its nodes if they come in order of their reversed symbols."""
    path, last = [_LEAF], ""
    for signature in signatures:
        backwards = signature[::-1]
        shared = 0
        while shared < min(len(last), len(backwards)) and last[shared] == backwards[shared]:
            shared += 1
        del path[shared + 1 :]
        for symbol in backwards[shared:]:
            path.append(node(symbol, path[-1]))
        last = backwards
        yield path[-1]


def _solved(segments: DataFrame) -> DataFrame:
    """Segments with costs and audits, for each pair of grammar states at their edges."""
    order = ["backwards", "conv_id", "turn", "name", "digest", "copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The automaton goes on from batch to batch.
        feed: list[str] = []
        nodes = automaton(iter(feed.pop, None))
        for batch in batches:
            costs, audits = [], []
            for signature in batch.column("signature").to_pylist():
                feed.append(signature)
                ways = [w for row in next(nodes) for w in row]
                costs.append([w and w[0] for w in ways])
                audits.append([w and w[1] for w in ways])
            columns = [batch.column(c) for c in names] + [pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))]
            yield pa.record_batch(columns, [*names, "costs", "audits"])

    names = ["conv_id", "turn", "name", "digest", "copy", "illegal", "head", "tail"]
    schema = f"{_PLACE}, illegal long, head string, tail string, costs array<long>, audits array<string>"
    backwards = segments.withColumn("backwards", F.reverse("signature"))
    # The place is part of the range, so that a signature of very many conversations is spread over tasks.
    return backwards.repartitionByRange(*order).sortWithinPartitions(*order).select(*names, "signature").mapInArrow(run, schema)


def _less(a: tuple, b: tuple) -> bool:
    """Whether the audit a comes before b; both are chains (text, rest) of equal cost."""
    (x, a), (y, b) = a, b
    while True:
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x < y
        x, y = x[n:], y[n:]
        if a is b and not x and not y:
            return False
        if not x:
            if a is None:
                return bool(y)
            x, a = a
        if not y:
            if b is None:
                return False
            y, b = b


def _folded(segments: Iterable[dict]) -> Iterator[dict]:
    """conv_id, cost, audit and illegal from the segments of conversations, the last one of each first."""
    last, ways, illegal = None, None, 0

    def told() -> dict:
        cost, chain = ways[0]
        texts = []
        while chain:
            texts.append(chain[0])
            chain = chain[1]
        return {"conv_id": last["conv_id"], "cost": cost, "audit": "".join(texts), "illegal": illegal}

    for segment in segments:
        if last is None or last["conv_id"] != segment["conv_id"]:
            if last is not None:
                yield told()
            ways, illegal = [(cost, (text, None)) for cost, text in _END], 0
        else:
            illegal += segment["tail"] + last["head"] not in _LEGAL
        illegal += segment["illegal"]
        found = []
        for q in _STATES:
            best = None
            for e in _STATES:
                cost, audit = segment["costs"][4 * q + e], segment["audits"][4 * q + e]
                if cost is not None:
                    way = (cost + ways[e][0], (audit, ways[e][1]))
                    if best is None or way[0] < best[0] or (way[0] == best[0] and _less(way[1], best[1])):
                        best = way
            found.append(best)
        ways, last = found, segment
    if last is not None:
        yield told()


def _edits(solved: DataFrame) -> DataFrame:
    backwards = [F.desc(c) for c in ("turn", "name", "digest", "copy")]
    schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64())])
    parts = solved.repartition("conv_id").sortWithinPartitions("conv_id", *backwards)
    return parts.mapInArrow(lambda batches: _batched(_folded(_dicts(batches)), schema), "conv_id long, cost long, audit string, illegal long")


class Repaired:
    """The rows of one conversation as its audit repairs them, one row at a time."""

    _NEXT = {"s": "user", "u": "assistant", "a": "user"}  # noqa: RUF012

    def __init__(self, audit: str):
        self.audit, self.at, self.due, self.lines = audit, 0, "user", 0

    def _line(self, role: str, text: str) -> str:
        self.due = self._NEXT[role[0]]
        self.lines += 1
        return f"{role}:{text}"

    def inserted(self) -> Iterator[str]:
        """Rows to insert before the next one, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._line(self.due, "")

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._line(role if letter == "K" else self.due, text)


_COUNTS = ["gaps", "blank", "duplicate", "truncated"]
_RESULT = ["conv_id", *_COUNTS, "illegal", "cost", "audit", "repaired_sha256"]


def _hashed(rows: Iterable[dict]) -> Iterator[dict]:
    """Results of conversations, each of which comes as its counts (kind 0), its edits (kind 1) and its rows (kind 2)."""
    counts, edits, repaired, digest = None, {}, None, None

    def add(lines: Iterable[str]) -> None:
        for line in lines:
            digest.update(("\n" if repaired.lines > 1 else "").encode() + line.encode())

    def told() -> dict:
        add(repaired.inserted())
        return counts | {"illegal": edits.get("illegal", 0), "cost": edits.get("cost", 0), "audit": edits.get("audit", ""), "repaired_sha256": digest.hexdigest()}

    for row in rows:
        if row["kind"] == 0:
            if counts is not None:
                yield told()
            counts, edits = {c: row[c] for c in ("conv_id", *_COUNTS)}, {}
            repaired, digest = Repaired(""), hashlib.sha256()
        elif row["kind"] == 1:
            edits, repaired = row, Repaired(row["audit"])
        else:
            for _ in range(row["copies"]):
                add(repaired.row(row["role"], row["text"]))
    if counts is not None:
        yield told()


def repair(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation in `turns`.

    `turns` has conv_id, turn, role and text, is damaged first, and other columns are ignored. Null roles and texts
    are one blank; rows without turn come first; rows of one turn follow by role (32 characters of it) and then by a
    digest of role and text; equal rows stand together. Rows without conv_id are one conversation. A conversation
    without rows after damage has zeros, no edits and the hash of nothing. No rows give no rows.
    """
    rows = _ordered(damaged(turns))
    classified = checkpoint(_classified(rows))
    edits = _edits(_solved(checkpoint(_segments(classified, size))))
    counts = _counts(rows, classified)
    texts = rows.where("copies > 0").select("conv_id", "turn", "name", "digest", "copies", "role", "text")
    parts = [part.withColumn("kind", F.lit(kind)) for kind, part in enumerate((counts, edits, texts))]
    joined = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    joined = joined.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "name", "digest")
    text, long = pa.string(), pa.int64()
    schema = pa.schema([(c, text if c in ("audit", "repaired_sha256") else long) for c in _RESULT])
    result = ", ".join(f"{c} {'string' if c in ('audit', 'repaired_sha256') else 'long'}" for c in _RESULT)
    return joined.mapInArrow(lambda batches: _batched(_hashed(_dicts(batches)), schema), result)
