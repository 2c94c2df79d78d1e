import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from deedmill.llm import idfile

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(docs):
    library = Tokenizer.from_file(PATH)
    rows = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [0]) for r in docs.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def expected(docs):
    start, out = 0, []
    for doc_id, ids in brute(docs):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_given_table(spark, some_docs):
    got = idfile.query(some_docs, PATH)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(some_docs))


def test_hard_rows(spark, hard_docs, tmp_path):
    """Rows of one doc_id may follow in any order; all else is fixed."""
    folder = f"file://{tmp_path}/ids"
    idfile.write(hard_docs, PATH, folder, block_ids=7, file_ids=20)
    got = sorted(idfile.read(spark, folder).collect(), key=lambda r: r.start)
    assert len(list((tmp_path / "ids").glob("*.ids"))) > 3
    starts = np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.start for r in got] == starts
    assert [r.doc_id for r in got] == [d for d, _ in brute(hard_docs)]
    as_pairs = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert sorted(as_pairs, key=str) == sorted(brute(hard_docs), key=str)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def test_empty_table(spark, no_docs):
    assert idfile.query(no_docs, PATH).collect() == []


def test_failed_and_repeated_tasks_leave_nothing_double(spark, some_docs, tmp_path):
    folder = f"{tmp_path}/ids"
    idfile.write(some_docs, PATH, folder)
    before = sorted(map(tuple, idfile.read(spark, folder).collect()))
    # Files that no committed task named, as a lost attempt leaves them.
    (tmp_path / "ids" / "part-000000-0000-lost.ids").write_bytes(b"half a file")
    assert sorted(map(tuple, idfile.read(spark, folder).collect())) == before
    one = next((tmp_path / "ids").glob("part-*.ids"))
    broken = bytearray(one.read_bytes())
    if one.name.endswith("lost.ids"):
        return
    broken[-1] ^= 1
    one.write_bytes(bytes(broken))
    with pytest.raises(Exception, match="damaged"):
        idfile.read(spark, folder).collect()


def test_codes():
    random = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = (random.integers(0, 1 << 32, n, dtype=np.uint64) >> random.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = idfile.pack_ranks(ranks)
        assert len(control) == -(-n // 4) and len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
        assert (idfile.unpack_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == ranks).all()


@pytest.mark.parametrize("width", [2, 4])
def test_cache_is_emptied(monkeypatch, width):
    monkeypatch.setattr(idfile, "CACHE_SIZE", 5)
    encoder, library = idfile.Encoder(PATH, width), Tokenizer.from_file(PATH)
    texts = ["a b c", "one two three four five six seven", "", "a b d <|endoftext|> e", "x" * 100, "q r", "日本 \n\n é\u00ad\x00\x7f  it's"]
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text), f"<u{width}").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder) <= 5


def test_frequent_ids_come_first(spark, some_docs):
    ranked = idfile.ranking(idfile.encoded(some_docs, PATH, 2), 2).tolist()
    assert idfile.id_width(PATH) == 2
    counts = np.bincount(np.concatenate([ids for _, ids in brute(some_docs)]))
    assert ranked == sorted(np.nonzero(counts)[0].tolist(), key=lambda i: (-counts[i], i))


def test_fast_split_is_the_library_s():
    random = np.random.default_rng(4)
    encoder, library = idfile.Encoder(PATH, 2), Tokenizer.from_file(PATH)
    alphabet = [*map(chr, range(0x180)), *map(chr, range(0x2010, 0x2028)), *" \n\t'  abcsdmtlvre019.,"] + ["'s", "'ll", "'re", "  ", "\n\n", "\x1c", "\x85", "\xa0"]
    for n in range(4000):
        text = "".join(random.choice(alphabet, int(random.integers(1, 30))))
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
