"""Personal data found by labelers that vote, weighted by expectation-maximisation, and a classifier of spans.

Candidates are the spans of fixed base patterns and of looser ones. Four labelers vote on each: the base pattern, a
gazetteer (ends of host names, card issuers, country codes), the words before the span, and its edges. Votes are
counted over all texts by Spark; from the counts, expectation-maximisation estimates how reliable each labeler is
for each kind, and so how likely each combination of votes is personal data. A logistic model of the span's own
features is then trained on these likelihoods, with every combination of features counted in all texts.

Base spans are always reported; the classifier adds looser ones of which it is sure.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deedmill.llm.common import id_and_text, map_batches

KINDS = ("email", "ip", "card", "phone")
#: The likelihood from which the classifier adds a span.
SURE = 0.9
CONTEXT = 40
ROUNDS = 60

# The base patterns. Possessive repeats and look-behinds only save time.
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser patterns, all of bounded length.
_LOOSE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?"
        r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]{1,63}){1,5}"
    ),
    "ip": re.compile(r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}([.\x20-]?)[0-9]{4,6}\1[0-9]{4,5}(?:\1[0-9]{4})?(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+A-Za-z])(?:\([0-9]{2,4}\)\x20?|00[1-9][0-9]{0,2}[\x20-]|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])"),
}
_DIGIT = re.compile(r"[0-9]")
_BRACKETED = re.compile(r"[\[(]\x20?at\x20?[\])]")

# Gazetteers.
ENDS = {"com", "org", "net", "edu", "gov", "int", "io", "info", "biz", "de", "fr", "es", "uk", "eu", "us", "ca", "at", "ch", "it", "nl", "be", "pl", "mx", "ar"}
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "6011", "65")
COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "65", "81", "82", "86", "91")
NEAR = re.compile(r"\b(?:e-?mails?|mail|correo|contacte?|contact[oa]?|kontakt|tel|phone|call|fax|mobile|mobil|téléphone|teléfono|telefon|card|visa|credit|carte|tarjeta|karte|ip|host|server|adresse|address)\b", re.I)
FAR = re.compile(r"\b(?:version|isbn|order|token|key|secret|sha|hash|invoice|serial|release|build)\b", re.I)

Span = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind as listed, then start."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _HOST.match(text, at + 1)):
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        # 16 to 19 digits with a separator between any two at most.
        if 16 <= m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                found.append(("phone", *m.span()))
    return found


def loose_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of the looser patterns that meet no base span."""
    digit = _DIGIT.search(text)
    found = []
    for kind in KINDS:
        if digit if kind != "email" else _BRACKETED.search(text):
            found += [(kind, *m.span()) for m in _LOOSE[kind].finditer(text)]
    if not found or not base:
        return found
    starts, ends = np.array(sorted(s for _, s, _ in base)), np.array(sorted(e for _, _, e in base))
    meets = lambda s, e: np.searchsorted(starts, e, "left") > np.searchsorted(ends, s, "right")
    return [x for x in found if not meets(x[1], x[2])]


def votes(text: str, span: Span, is_base: bool) -> str:
    """A character a labeler: 1 for, 0 against, - for no vote."""
    kind, start, end = span
    said, digits = text[start:end], _digits(text[start:end])
    if kind == "email":
        listed = re.split(r"[^A-Za-z0-9]+", said.rstrip("])"))[-1].lower() in ENDS
    elif kind == "ip":
        listed = ":" in said or not any(len(p) > 1 and p[0] == "0" for p in said.split("."))
    elif kind == "card":
        listed = digits.startswith(ISSUERS) and luhn(digits)
    else:
        listed = digits.startswith(COUNTRIES) if said[0] == "+" else said.startswith("00") or digits[0] not in "01"
    before = text[max(0, start - CONTEXT) : start]
    context = "1" if NEAR.search(before) else "0" if FAR.search(before) else "-"
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = (not left or left in " \t\n\r(<[,;:\"'") and (not right or right in " \t\n\r)>],;:.!?\"'")
    return f"{int(is_base)}{int(listed)}{context}{int(edges)}"


def span_features(text: str, span: Span) -> str:
    """The span's own features, a character each; every one has a small alphabet."""
    kind, start, end = span
    said = text[start:end]
    n_digits = len(_DIGIT.findall(said))
    size = min(9, (end - start) // 5)
    share = min(4, 5 * n_digits // (end - start))
    mark = next((c for c in "@.-( :" if c in said), "0").replace(" ", "_")
    left, right = text[start - 1 : start], text[end : end + 1]
    edge = lambda c: "e" if not c else "s" if c.isspace() else "w" if c.isalnum() else "p"
    valid = int(luhn(_digits(said)) if kind == "card" else n_digits >= 7 if kind == "phone" else True)
    groups = min(5, len(re.findall(r"[0-9]+", said)))
    return f"{size}{share}{mark}{edge(left)}{edge(right)}{valid}{groups}"


def reliabilities(counts: dict[str, float]) -> tuple[float, np.ndarray]:
    """Share of personal data among candidates with these votes, and for each labeler the chance of voting for, by class.

    Row 0 holds the chances for spans that are none, row 1 for spans that are.
    """
    patterns = list(counts)
    n = np.array([counts[p] for p in patterns], float)
    cast = np.array([[c != "-" for c in p] for p in patterns], float)
    vote = np.array([[c == "1" for c in p] for p in patterns], float)
    belief = (vote.sum(1) + 0.5) / (cast.sum(1) + 1)
    share, chance = 0.5, np.full((2, vote.shape[1]), 0.5)
    for _ in range(ROUNDS):
        weights = np.stack([n * (1 - belief), n * belief])
        share = (weights[1].sum() + 1) / (n.sum() + 2)
        chance = (weights @ (vote * cast) + np.array([[1.0], [3.0]])) / (weights @ cast + 4)
        chance = np.clip(chance, 1e-3, 1 - 1e-3)
        belief = likelihood(patterns, share, chance)
    return share, chance


def likelihood(patterns: list[str], share: float, chance: np.ndarray) -> np.ndarray:
    cast = np.array([[c != "-" for c in p] for p in patterns], float)
    vote = np.array([[c == "1" for c in p] for p in patterns], float)
    log = [(cast * (vote * np.log(c) + (1 - vote) * np.log(1 - c))).sum(1) for c in chance]
    return 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log((1 - share) / share), -60, 60)))


@dataclass(frozen=True)
class Model:
    """Weights of features, named kind, place and value; unseen ones weigh nothing."""

    weights: dict[str, float]

    def chance(self, kind: str, features: str) -> float:
        z = self.weights.get(kind, 0.0) + sum(self.weights.get(f"{kind}{i}{c}", 0.0) for i, c in enumerate(features))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def train(rows: list[tuple[str, str, str, int]]) -> Model:
    """`rows` are (kind, votes, features, count): all combinations in the corpus."""
    weights: dict[str, float] = {}
    for kind in KINDS:
        own = [r for r in rows if r[0] == kind]
        if not own:
            continue
        counts: Counter[str] = Counter()
        for _, vote, _, n in own:
            counts[vote] += n
        share, chance = reliabilities(counts)
        target = likelihood([r[1] for r in own], share, chance)
        names = sorted({f"{kind}{i}{c}" for r in own for i, c in enumerate(r[2])})
        place = {x: i for i, x in enumerate(names)}
        x = np.zeros((len(own), len(names) + 1))
        x[:, -1] = 1
        for row, r in enumerate(own):
            x[row, [place[f"{kind}{i}{c}"] for i, c in enumerate(r[2])]] = 1
        n = np.array([r[3] for r in own], float)
        n *= len(own) / n.sum()
        w = np.zeros(x.shape[1])
        for _ in range(30):  # Newton steps on the penalised log likelihood
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (n * (p - target)) + 0.1 * w
            curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        weights |= dict(zip(names, w[:-1].tolist(), strict=True)) | {kind: float(w[-1])}
    return Model(weights)


def fit(docs: DataFrame) -> Model:
    """Count votes and features of all candidates in all texts and train on the counts, whose number their alphabets bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[tuple[str, str, str]] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                base = base_spans(text) if text else []
                for spans, is_base in ((base, True), (loose_spans(text, base) if text else [], False)):
                    counter.update((s[0], votes(text, s, is_base), span_features(text, s)) for s in spans)
        columns = [list(c) for c in zip(*counter, strict=True)] or [[], [], []]
        yield pa.record_batch(
            [*(pa.array(c, pa.string()) for c in columns), pa.array(list(counter.values()), pa.int64())], ["kind", "votes", "features", "n"]
        )

    counted = id_and_text(docs).select("text").mapInArrow(run, "kind string, votes string, features string, n long")
    totals = counted.groupBy("kind", "votes", "features").agg(F.sum("n").alias("n")).orderBy("kind", "votes", "features")
    return train([tuple(r) for r in totals.collect()])


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans, each by kind as listed, then start."""
    base = base_spans(text)
    sure = [s for s in loose_spans(text, base) if model.chance(s[0], span_features(text, s)) >= SURE]
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + sure, key=lambda s: (order[s[0]], s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; spans that overlap are replaced as one, by the first one's kind."""
    parts, done, reach = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= reach:
            parts += [text[done:start], f"<{kind.upper()}>"]
        reach = done = max(reach, end)
    return "".join(parts) + text[done:]


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added, a row for each row of `docs`.

    The counts and the hash are those of base spans. A null or empty text has none: counts of 0, empty spans and the
    hash of the empty string. Null and repeated doc_ids are passed on. No rows give no rows; without candidates
    nothing is learned and nothing added. Other columns are ignored.
    """
    model = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [all_spans(t, shared.value) if t else ([], []) for t in batch.column(1).to_pylist()]
        counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS]
        columns = [pa.array(c, pa.int64()) for c in counts]
        columns += [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], pa.string())]
        columns += [pa.array([joined(s) for _, s in found], pa.string()), pa.array([len(s) - len(b) for b, s in found], pa.int64())]
        return pa.record_batch([batch.column(0), *columns], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_batches(id_and_text(docs), run, schema)


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All rows and columns of `docs` with personal data in `text` replaced and `n_chars` counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs))
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t and redact(t, all_spans(t, shared.value)[1]) for t in batch.column(names.index("text")).to_pylist()]
        columns = list(batch.columns)
        columns[names.index("text")] = pa.array(texts, batch.schema.field("text").type)
        if "n_chars" in names:
            sizes = [None if t is None else len(t) for t in texts]
            columns[names.index("n_chars")] = pa.array(sizes, batch.schema.field("n_chars").type)
        return pa.record_batch(columns, schema=batch.schema)

    return map_batches(docs, run, docs.schema)
