import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from deedmill.llm import mixing


@pytest.mark.parametrize("weights", [{"a": 0.5, "b": 0.25}, {"a": 0.9, "b": 0.05, "c": 0.01}, {f"s{i}": 1 / 37 for i in range(36)}, mixing.WEIGHTS])
def test_schedule_keeps_every_source_within_a_block(weights):
    share = mixing.shares(weights, 100)
    assert sum(share.values()) == 100 and all(a > 0 for a in share.values())
    done = Counter()
    for source, a, block, slot, slots in mixing.schedule(share):
        assert block == done[source] and block * slots // a <= slot < -(-(block + 1) * slots // a)
        done[source] += 1
        assert all(abs(done[s] - Fraction(share[s] * (slot + 1), slots)) < 1 for s in share)


def by_hand(rows, weights, slots, block_bytes):
    share = mixing.shares(weights, slots)
    at = {(s, b): slot for s, _, b, slot, _ in mixing.schedule(share)}
    pools = defaultdict(list)
    for doc_id, text, source in rows:
        pools[source if source in share else "*"].append((doc_id, text, source))
    out = []
    for pool, docs in pools.items():
        start, a = 0, share[pool]
        md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
        for doc_id, text, source in sorted(docs, key=lambda d: (md5("" if d[0] is None else str(d[0])), d[0] or 0, md5(d[1] or ""))):
            b = start // block_bytes
            out.append((doc_id, source, pool, b, b * slots // a, -(-(b + 1) * slots // a), b // a * slots + at[pool, b % a]))
            start += len((text or "").encode())
    return out


def test_places(spark, hard_docs, no_docs, some_docs):
    key = lambda r: tuple((x is None, x) for x in r)
    for docs in (hard_docs, some_docs, no_docs):
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        weights = {"src0": 0.4, "src1": 0.3}
        placed = mixing.place(docs, weights, 50, 1000)
        got = placed.select("row.doc_id", "row.source", "pool", "block", "release", "deadline", "slot").collect()
        assert sorted(map(tuple, got), key=key) == sorted(by_hand(rows, weights, 50, 1000), key=key)


def test_mixed_keeps_all_rows_in_order(hard_docs, some_docs):
    got = mixing.mixed(hard_docs, mixing.WEIGHTS)
    assert got.columns == hard_docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, hard_docs.collect()))
    slots = {r.doc_id: r.slot for r in mixing.query(some_docs).collect()}
    order = [slots[r.doc_id] for r in mixing.mixed(some_docs, mixing.WEIGHTS).collect()]
    assert order == sorted(order)


def test_bad_weights():
    with pytest.raises(ValueError):
        mixing.shares({"a": 0.0})
