import hashlib
import re

from deedmill.llm import pii


def plain(text):
    """The base definition, with the patterns as they are written."""
    found = {k: [] for k in pii.KINDS}
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found["email"].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.findall("[0-9]", m[0])) <= 15:
            found["phone"].append(m.span())
    return [(k, *s) for k in pii.KINDS for s in found[k]]


TEXTS = [
    "", "a@b.c", "a@b", "@x.y z@x.y.", "a@b@c.d.e@f.g", "x..y%+-@a-b.c-d.e..f", "aä@b.c é@b.c", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.255",
    "0001.02.003.4", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "1  2",
    "+1 (555) 010-9999", "+123", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++49 30 1234567", "+4 +49.30.123456 x", "١٢٣٤ ۴.۵.۶.۷", "a" * 3000 + "@" + "b" * 3000 + ".c",
    "1" * 3000, "1.1." * 500, "+" * 500 + "1" * 500,
]


def test_base_spans(some_docs):
    texts = TEXTS + [r.text for r in some_docs.select("text").collect()]
    for text in texts:
        assert pii.base_spans(text) == plain(text), text[:80]


def test_long_texts_take_linear_time():
    for unit in ("a", "1", "1.", "+1", "a@", "1 ", "-", "1@a."):
        pii.base_spans(unit * 200_000)


def test_expectation_maximisation_finds_the_unreliable_labeler():
    # Labelers 0 and 1 agree with the truth; labeler 2 votes at random, labeler 3 never votes.
    counts = {"111-": 450.0, "110-": 450.0, "001-": 450.0, "000-": 450.0, "101-": 20.0, "010-": 20.0}
    share, chance = pii.reliabilities(counts)
    assert abs(share - 0.5) < 0.1
    assert chance[1][0] > 0.9 > 0.1 > chance[0][0] and abs(chance[1][2] - chance[0][2]) < 0.1
    assert pii.likelihood(["110-"], share, chance)[0] > 0.9 > 0.1 > pii.likelihood(["001-"], share, chance)[0]


def test_query_and_hard_rows(spark, hard_docs, no_docs):
    got = pii.find(hard_docs).collect()
    texts = sorted((r.doc_id or 0, r.text or "") for r in hard_docs.collect())
    want = sorted((i, pii.joined(plain(t)), [sum(s[0] == k for s in plain(t)) for k in pii.KINDS]) for i, t in texts)
    assert sorted((r.doc_id or 0, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) for r in got) == sorted(
        (i, n, hashlib.sha256(j.encode()).hexdigest()) for i, j, n in want
    )
    assert pii.find(no_docs).collect() == []


def test_adds_looser_spans_and_redacts(spark):
    rows = [(i, f"Please call (212) 555-01{i % 90 + 10} or mail to ann{i}@mail.example.com, phone +1 (212) 555-01{i % 90 + 10} today.") for i in range(200)]
    rows += [(1000 + i, f"Plain text number {i} with version 1.2 and nothing else.") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert all(r.n_email == 1 and r.n_phone == 1 and r.base_sha256 for i, r in found.items() if i < 1000)
    assert all(r.spans == "" for i, r in found.items() if i >= 1000)
    for i, r in found.items():
        base = pii.joined(plain(dict(rows)[i]))
        assert all(b in r.spans.split(",") for b in base.split(",") if b)
    clean = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert "@" not in clean[5] and "<EMAIL>" in clean[5] and "+1" not in clean[5] and clean[1005] == dict(rows)[1005]


def test_redact_overlaps():
    assert pii.redact("abcdefgh", [("ip", 1, 4), ("card", 3, 6)]) == "a<IP>gh"
    assert pii.redact("abc", []) == "abc"
