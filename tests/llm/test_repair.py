import hashlib
import heapq
import random
import re
import zlib

import pytest

from deedmill.llm import repair

SHOWN = re.compile(r"[^\x20\x09-\x0D]")


def broken(rows):
    """conv_id to its rows (turn, role, text) after damage, in order; conversations without rows too."""
    found = {}
    for conv_id, turn, role, text in rows:
        blank = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{blank(conv_id)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found.setdefault(conv_id, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1][:32], digest(x[1], x[2]))) for c, r in found.items()}


def cheapest(rows, faults):
    """Cost, audit and repaired rows: all ways from the first row on, the cheapest and least first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, said, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, out
        state = said[-1:] + ("" if len(said) > 1 else "1")
        if (at, state) in done or (said and not re.fullmatch("s?(ua)*u?", said)):
            continue
        done.add((at, state))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", at, said + role[0], (*out, (role, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, said, out))
            if faults[at] not in ("blank", "duplicate"):
                late = 3 if faults[at] == "truncated" else 0
                heapq.heappush(heap, (cost + late, audit + "K", at + 1, said + (role[:1] if role[:1] in ("s", "u", "a") else "x"), (*out, (role, text))))
                for other in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 3 + late, audit + "R", at + 1, said + other[0], (*out, (other, text))))
    raise AssertionError


def brute(table):
    out = []
    for conv_id, rows in broken(table).items():
        faults, seen = [], set()
        for _, role, text in rows:
            shown = SHOWN.findall(text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = cheapest(rows, faults)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def check(turns, **options):
    got = repair.repair(turns, **options)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


SCHEMA = "conv_id long, turn long, role string, text string, kind string, n long, digest string, copies long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 5, "d", 9) for r in rows], SCHEMA)


def test_given_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))


@pytest.mark.parametrize("size", [2, 5, 128])
def test_random_conversations_cut_anywhere(spark, size):
    rng = random.Random(size)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", None], ["Yes.", "No!", "and", " \t", "", "Why?\n", None]
    rows = []
    for conv in range(60):
        turn = 0
        for _ in range(rng.choice([1, 2, 3, 8, 20])):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            text = rng.choice(texts) if rng.random() < 0.4 else f"Sentence {rng.random()}{rng.choice(['.', '', '!'])}"
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn, roles[turn % 2] if rng.random() < 0.7 else rng.choice(roles), text))
    rows += rows[:5] * 3
    check(frame(spark, rows).repartition(4), size=size)


def test_one_conversation_with_most_rows(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"Line {i % 50}.") for i in range(600)] + [(1, 7, "user", "ok")] * 300
    rows += [(2, i, "user", "ok.") for i in range(40)] + [(3, None, None, None)] * 5
    check(frame(spark, rows).repartition(7))


def test_very_long_texts_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 200_000), (1, 1, "assistant", "word " * 200_000 + "."), (4, 0, "user" * 50, "x.")]
    check(frame(spark, rows))
    assert repair.repair(frame(spark, rows).limit(0)).collect() == []


def test_nodes_are_made_once(monkeypatch):
    made, true = [], repair.node
    monkeypatch.setattr(repair, "node", lambda symbol, rest: made.append(symbol) or true(symbol, rest))
    signatures = sorted(["ua", "suaua", "uaua", "-uaua", "ua", "uu", "aua"], key=lambda s: s[::-1])
    nodes = list(repair.automaton(signatures))
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s))})
    again = {s: n for s, n in zip(signatures, nodes, strict=True)}
    assert again["ua"][0][3] == (0, "KK") and again["uu"][0][3] == (3, "KR")
