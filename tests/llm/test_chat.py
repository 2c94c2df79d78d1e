from collections import defaultdict

from deedmill.llm import chat


def by_hand(turns, window):
    dialogues = defaultdict(list)
    for conv, turn, role, text in turns:
        dialogues[conv].append((-1 if turn is None else turn, role or "unknown", text or ""))
    out = set()
    for conv, said in dialogues.items():
        for speaker in {r for _, r, _ in said} - {"system"}:
            start, parts = 0, defaultdict(list)
            for turn, role, text in sorted(said):
                tag = "assistant" if role == speaker else role if role == "system" else f"user name={role}"
                head = f"<|{tag}|>\n"
                piece = f"{head}{text}<|end|>\n"
                parts[start // window].append((start, len(head), piece, role == speaker))
                start += len(piece)
            for part, pieces in parts.items():
                first = pieces[0][0]
                mask = [(s - first + h, s - first + len(p) - 1) for s, h, p, own in pieces if own]
                text = "".join(p for _, _, p, _ in pieces)
                out.add((conv, speaker, part, len(pieces), len(text), sum(b - a for a, b in mask), text, ",".join(f"{a}:{b}" for a, b in mask)))
    return out


def test_perspectives(spark):
    turns = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello ü🙂"), (1, 3, "ann", None), (1, 3, "ann", "again"),
        (2, 0, "system", "alone"), (3, None, None, "no turn"), (3, 5, "x", ""), (None, 1, "y", "no dialogue"), (4, 1, "z", "same"), (4, 1, "z", "same"),
        *[(5, i, "abc"[i % 3], "word " * (i % 7)) for i in range(600)], (6, 0, "long", "l" * 50_000), (6, 1, "other", "o"),
    ]
    rows = [(*t, 1, "s", 2) for t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start long, speaker string, part long")
    for window in (300, chat.WINDOW):
        got = chat.rotate(df, window).collect()
        assert len(got) == len(by_hand(turns, window))
        assert {tuple(r) for r in got} == by_hand(turns, window)
    assert chat.rotate(df.limit(0)).collect() == []


def test_mask_marks_own_texts(spark):
    df = spark.createDataFrame([(1, 0, "a", "one"), (1, 1, "b", "two"), (1, 2, "a", "three")], "conv_id long, turn long, role string, text string")
    for r in chat.rotate(df).collect():
        own = [r.text[slice(*map(int, m.split(":")))] for m in r.mask.split(",")]
        assert own == {"a": ["one<|end|>", "three<|end|>"], "b": ["two<|end|>"]}[r.speaker]
