import hashlib

import numpy as np
import pyarrow as pa
import pytest

from deedmill.llm import suffixes


def by_hand(rows):
    """(doc_id, bytes, removed, spans, hash of what is kept) by looking up every string."""
    first = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for p in range(len(data) - 49):
            first.setdefault(data[p : p + 50], doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49 if doc_id is not None else 0):
            if first[data[p : p + 50]] < doc_id:
                gone[p : p + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) and gone[0])
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages():
    random = np.random.default_rng(1)
    words = ["".join(chr(97 + c) for c in random.integers(0, 26, random.integers(2, 8))) for _ in range(300)]
    text = lambda n: " ".join(words[i] for i in random.integers(0, 300, n))
    shared = [text(12), text(30), "é" * 40 + "ü" * 20, "a" * 400, "ab" * 100, text(8)[:49], (text(20) + "x" * 60)[:50]]
    rows = []
    for i in range(120):
        parts = [text(int(random.integers(0, 15)))]
        for j in random.integers(0, len(shared), 3):
            s = shared[j]
            parts += [s if random.random() < 0.6 else s[: int(random.integers(1, len(s)))], text(3)]
        rows.append((int(random.integers(0, 100)), "".join(parts)))
    return rows + [(500, shared[1] + shared[0]), (501, "a" * 49), (502, "a" * 50), (-1, "a" * 51), (503, None), (504, ""), (None, shared[1] + "tail")]


@pytest.mark.parametrize("chunk", [suffixes.CHUNK, 300])
def test_against_all_strings(spark, chunk, monkeypatch):
    rows = passages()
    monkeypatch.setattr(suffixes, "CHUNK", chunk)
    schema = "doc_id long, text string"
    got = suffixes.query(spark.createDataFrame(rows, schema).repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_hand(rows)
    one = suffixes.query(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    assert sorted((tuple(r) for r in one), key=str) == by_hand(rows)


def test_hard_rows_and_small_table(hard_docs, no_docs, some_docs):
    for docs in (hard_docs, some_docs):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted((tuple(r) for r in suffixes.query(docs).collect()), key=str) == by_hand(rows)
    assert suffixes.query(no_docs).collect() == []


def test_odd_byte_in_a_long_run(spark):
    rows = [(1, "*" * 200), (2, " " * 200)]
    rows += [(3 + i, c + o + c[:1] * 90) for i, (c, o) in enumerate((c * 50, o) for c in "* " for o in "\nbcd-#!/_")]
    rows += [(100 + n, "*" * n + "?" + "*" * 150) for n in range(40, 70)]
    got = suffixes.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_hand(rows)


def test_kept_bytes(spark):
    line = "this line of text is longer than fifty bytes, so it counts as a repeat. "
    docs = spark.createDataFrame([(1, line + "one"), (2, "two " + line + "2")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in suffixes.remove_repeats(docs).collect()}
    assert kept[1] is None and kept[2] == b"two 2"


def test_family_keeps_levels_few_and_the_smallest_document():
    random = np.random.default_rng(5)
    family, known = suffixes.Family(), {}
    for _ in range(64):
        keys = random.integers(0, 500, 40).astype(np.uint64)
        checks, docs = (keys % 7).astype(np.uint32), random.integers(0, 10_000, 40)
        family.add(keys, checks, docs)
        for k, d in zip(keys.tolist(), docs.tolist(), strict=True):
            known[k] = min(d, known.get(k, d))
        sizes = [len(level[0]) for level in family.levels]
        assert all(a > suffixes.RATIO * b for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) == len(known)
    keys = np.array(list(known), np.uint64)
    assert family.smallest(keys, (keys % 7).astype(np.uint32)).tolist() == list(known.values())


def test_slices_of_any_size_give_the_same(spark, some_docs, monkeypatch):
    sizes = [3, 0, 1 << 23, 5, 1 << 21, 1 << 21, 1]
    batch = pa.record_batch([pa.array(range(len(sizes)))], ["i"])
    slices = [s.column(0).to_pylist() for s in suffixes._sliced(batch, sizes)]
    assert slices == [[0, 1], [2], [3, 4], [5, 6]] and list(suffixes._sliced(batch.slice(0, 0), [])) == []


def test_pieces_hold_every_string_once_and_equal_strings_have_equal_anchors(monkeypatch):
    texts = [(t or "").encode() for _, t in passages()] + [b"*" * 50, b"", b"x" * 49, b"ab" * 400]
    for chunk in (suffixes.CHUNK, 300):
        monkeypatch.setattr(suffixes, "CHUNK", chunk)
        seen, anchors, hashes, names = [], {}, {}, {}
        for p in suffixes.scan(texts):
            piece, inner, found = p.strings(np.arange(len(p.count)))
            for i, n, h in zip(piece.tolist(), inner.tolist(), found.tolist(), strict=True):
                at = int(p.start[i]) + n
                string = texts[p.text[i]][at : at + 50]
                seen.append((int(p.text[i]), at))
                assert anchors.setdefault(string, p.anchor[i]) == p.anchor[i] and hashes.setdefault(string, h) == h
            for text, start, count, name in zip(p.text.tolist(), p.start.tolist(), p.count.tolist(), p.name.tolist(), strict=True):
                whole = texts[text][start : start + count + 49]
                assert 1 <= count <= suffixes.IN_PIECE and len(whole) == count + 49 and names.setdefault(whole, name) == name
        assert sorted(seen) == [(i, at) for i, t in enumerate(texts) for at in range(len(t) - 49)]
        assert len(set(hashes.values())) == len(hashes) and len(set(names.values())) == len(names)


def lists(values):
    return pa.array([v if v is None else np.array(v, np.uint64).view(np.int64).tolist() for v in values], pa.list_(pa.int64()))


def test_short_texts_are_masked_in_common_scans(monkeypatch):
    # At sf0.1 most CPU time went into calls for texts of some hundred bytes one by one.
    texts = [f"line {i % 7} of some text that is rather longer than fifty bytes, and ends in {i}".encode() for i in range(2000)]
    pieces = [next(suffixes.scan([t])) for t in texts]
    removed = [None if i % 3 == 0 else p.name[:1] for i, p in enumerate(pieces)]
    shared = [None if i % 5 == 0 else p.name[-1:] for i, p in enumerate(pieces)]
    strings = [None if i % 4 == 0 else p.strings(np.arange(len(p.count)))[2][-2:] for i, p in enumerate(pieces)]
    expected = []
    for text, p, gone, some, hit in zip(texts, pieces, removed, shared, strings, strict=True):
        mask = np.zeros(len(text), bool)
        piece, inner, found = p.strings(np.arange(len(p.count)))
        for i, n, h in zip(piece, inner, found, strict=True):
            whole = gone is not None and p.name[i] in gone
            if whole or some is not None and p.name[i] in some and hit is not None and h in hit:
                mask[p.start[i] + n : p.start[i] + n + 50] = True
        expected.append(mask)
    scans, scan_chunk = [], suffixes._scan_chunk
    monkeypatch.setattr(suffixes, "_scan_chunk", lambda segments: scans.append(len(segments)) or scan_chunk(segments))
    got = suffixes._masks(texts, lists(removed), lists(shared), lists(strings))
    assert all((a == b).all() for a, b in zip(got, expected, strict=True)) and any(m.any() for m in got)
    assert len(scans) <= sum(map(len, texts)) // suffixes.CHUNK + 1


def test_slices_are_dealt_out_together(monkeypatch):
    def entries(part):
        keys = part.column(0).to_numpy().astype(np.uint64)
        yield keys, (keys % 3).astype(np.uint32), np.arange(len(keys)), (keys % 4).astype(np.int32)

    def rows():
        parts = (pa.record_batch([pa.array(range(i, i + 10))], ["key"]) for i in range(0, 100, 10))
        return [r for batch in suffixes._dealt_out(parts, entries) for r in batch.to_pylist()]

    together = rows()
    assert [r["shard"] for r in together] == [0, 1, 2, 3]
    monkeypatch.setattr(suffixes, "DEALT", 25)
    several = rows()
    assert [r["shard"] for r in several] == [0, 1, 2, 3] * 4
    keys = lambda found: sorted(k for r in found for k in suffixes.Batch.unpacked(r["data"]).keys.tolist())
    assert keys(together) == keys(several) == list(range(100))


def test_deal_and_decide_with_keys_of_several_checks(monkeypatch):
    monkeypatch.setattr(suffixes, "ADDED", 64)
    random = np.random.default_rng(3)
    keys, checks = random.integers(0, 40, 1000).astype(np.uint64), random.integers(0, 1000, 1000).astype(np.uint32)
    checks[keys > 2] = (keys % 5)[keys > 2]
    docs, shards = random.integers(0, 50, 1000), (keys % 3).astype(np.int32)
    found = {}
    for shard, data in suffixes._deal(keys, checks, docs, shards):
        b = suffixes.Batch.unpacked(data)
        assert (b.keys % 3 == shard).all() and (b.known_keys % 3 == shard).all()
        for k, c, d in zip(b.keys.tolist(), b.checks.tolist(), b.docs.tolist(), strict=True):
            assert (k, c) not in found
            found[k, c] = d
    least = {}
    for k, c, d in zip(keys.tolist(), checks.tolist(), docs.tolist(), strict=True):
        least[k, c] = min(d, least.get((k, c), d))
    assert found == least
    plain = keys > 2
    halves = [[suffixes.Batch.unpacked(x) for _, x in suffixes._deal(*(a[plain][at::2] for a in (keys, checks, docs, shards * 0)))] for at in (0, 1)]
    doc, key, flag = suffixes._decide(halves[0] + halves[1], True)
    gone = {(int(d), int(k)) for d, k in zip(docs[plain], keys[plain], strict=True) if d > least[int(k), int(k) % 5]}
    assert {(int(d), int(k)) for d, k in zip(doc[flag == 0], key[flag == 0], strict=True)} == gone
