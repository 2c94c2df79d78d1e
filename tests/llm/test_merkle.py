import hashlib
import zlib

import pytest

from deedmill.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _tree(nodes):
    """All levels of a tree, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _siblings(levels, at):
    """For each level, the run's other node (or none) and whether it stands before."""
    found = []
    for level in levels[:-1]:
        found.append((level[at ^ 1] if at ^ 1 < len(level) else None, at % 2 == 1))
        at //= 2
    return found


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r, _leaf(*(r[i] for i in (0, 3, 2, 4, 1)))))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = _tree([leaf for _, leaf in by_lang[lang]])
    top = _tree([trees[lang][-1][0] for lang in langs])
    out = []
    for i, lang in enumerate(langs):
        for j, (r, leaf) in enumerate(by_lang[lang]):
            path = _siblings(trees[lang], j) + _siblings(top, i)
            doc_id, text, _, source, n_chars = r
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            node = _leaf(doc_id, source, lang, n_chars + 1, text) if hit else leaf
            for sibling, before in path:
                node = _h(node) if sibling is None else _h(sibling, node) if before else _h(node, sibling)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[lang][-1][0], root, _h(*(s for s, _ in path if s)), node, node == root))
    return out


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def check(docs, levels=merkle.LEVELS):
    got = merkle.prove(merkle.build(docs, levels))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert rows_of(got) == sorted(brute(rows), key=str)
    return rows


def test_given_table_against_brute_force(spark, some_docs):
    rows = check(some_docs)
    got = merkle.query(some_docs).collect()
    hit = {r.doc_id for r in got if not r.verified}
    assert hit == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0} and hit


def test_hard_rows_and_empty_table(hard_docs, no_docs):
    check(hard_docs)
    assert merkle.query(no_docs).collect() == [] and merkle.build(no_docs).root is None


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_small_trees(spark, n):
    rows = [(i, "t", "en", "s", i) for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_many_records_deep(spark):
    """With records of four children, trees and the tree over them are several records deep."""
    rows = [(i, f"t{i}", None if i % 41 == 0 else f"l{i % 7 if i % 2 else 0}" if i < 300 else f"x{i}", "s", None if i % 5 == 0 else i) for i in range(330)]
    rows += [(7, "t7", "l0", "s", 7)] * 20 + [(None, "t", "l0", "s", 1)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    check(docs, 2)


def test_records_are_content_addressed(spark, some_docs):
    manifest = merkle.build(some_docs)
    records = manifest.records.collect()
    for r in records:
        children = [bytes(r.children[i : i + 32]).hex() for i in range(0, len(r.children), 32)]
        level = children
        for _ in range(r.height):
            level = [_h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        assert level == [bytes(r.digest).hex()]
    assert len({bytes(r.digest) for r in records}) == len(records)
