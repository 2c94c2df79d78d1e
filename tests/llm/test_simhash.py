import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from deedmill.llm import components, simhash


def by_hand(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, prints, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [least.get(find(i)) for i in range(len(ids))]


def test_whole_tables(hard_docs, no_docs, some_docs):
    for docs in (hard_docs, some_docs):
        rows = docs.select("doc_id", "text").collect()
        prints = [by_hand(r.text) for r in rows]
        want = [(r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, classes([r.doc_id for r in rows], prints), strict=True)]
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in simhash.query(docs).collect())
    assert simhash.query(no_docs).collect() == []


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 200), st.integers(1, 200), st.integers(0, 4))
def test_bit_sliced_distances(seed, n, m, radius):
    random = np.random.default_rng(seed)
    base = random.integers(0, 2**63, 4, dtype=np.uint64)
    some = lambda k: base[random.integers(0, 4, k)] ^ (np.uint64(1) << random.integers(0, 64, k).astype(np.uint64)) ^ (np.uint64(1) << random.integers(0, 64, k).astype(np.uint64))
    left, right = some(n), some(m)
    want = np.array([[(int(a) ^ int(b)).bit_count() <= radius for b in right] for a in left])
    rows, near = simhash.near_rows(left, right, radius)
    assert rows.tolist() == np.nonzero(want.any(axis=1))[0].tolist()
    assert (near == want[rows]).all()


@pytest.mark.parametrize("tile", [5, 2048])
def test_links_of_a_crowded_key(spark, tile):
    random = np.random.default_rng(3)
    flips = [0, 1, 3, 1 << 40, 1 << 41 | 1, 1 << 63]
    values = {int(random.integers(0, 2**62)) for _ in range(60)} | {(5 << 20 ^ f ^ (i << 1)) & (1 << 64) - 1 for f in flips for i in range(30)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "print long")
    roots = {r.node: r.root for r in components.components(simhash.links(df, tile=tile)).collect()}
    got = [roots.get(v, v) for v in signed]
    want = classes(list(range(len(signed))), [v & (1 << 64) - 1 for v in signed])
    assert len({*zip(got, want, strict=True)}) == len(set(got)) == len(set(want))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 100)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (None, 3), (2000, -5)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {i: 1000 for i in range(1001, 1100)} | {2000: -5}


def test_keep_one(hard_docs, no_docs):
    kept = simhash.keep_one(hard_docs)
    assert kept.columns == hard_docs.columns and simhash.keep_one(no_docs).collect() == []
    ids = [r.doc_id for r in kept.collect()]
    named = {r.doc_id for r in simhash.query(hard_docs).collect() if r.doc_id == r.component_id and r.doc_id is not None}
    assert sorted(i for i in ids if i is not None) == sorted(named) and ids.count(None) == 2
