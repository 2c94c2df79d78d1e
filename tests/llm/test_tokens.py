import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from deedmill.llm import piecemerge, tokencount

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "   a", "a ", "a  b   c", "\n\n a\t\tb \r\n", "don't we'll I'M 'S", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext",
    "日本語 テキスト", "🙂🙂 👩‍👩‍👧 é", "\u0000\u0001\u007f\u0085  　x", "１２３ ½ ²", "▁▁ ▁a▁b", "<s></s><unk><0x0A>",
    "ß" * 100, "a" * 3000, "ab" * 1500, "ﬁﬂ Å", "ᾳ ǅ", "ẞ İ", "0123456789" * 30, "=" * 200, "-_-" * 80, "퟿\U0010ffff",
]


def test_every_character_counts_as_in_the_library():
    library, own = Tokenizer.from_file(BYTES), tokencount.Lengths(BYTES, {})
    wrong = []
    for start in range(0, 0x110000, 64):
        text = "a".join(f"{chr(c)}b {chr(c)}1{chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        if len(library.encode(text, add_special_tokens=False).ids) != own.count(text):
            wrong.append(hex(start))
    assert not wrong


def test_token_counts(spark, hard_docs, no_docs, some_docs):
    library = Tokenizer.from_file(BYTES)
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for docs in (texts, hard_docs, some_docs):
        want = []
        for r in docs.select("doc_id", "text").collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 512))
        for size in (3, tokencount.TABLE_SIZE):
            got = tokencount.count_tokens(docs, BYTES, size).collect()
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert tokencount.count_tokens(no_docs, BYTES).collect() == []


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHE_SIZE", 5)
    own = tokencount.Lengths(BYTES, {"the": 1})
    text = " ".join(f"word{i}" for i in range(200))
    assert own.count(text) == len(Tokenizer.from_file(BYTES).encode(text).ids) and len(own) <= 6


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokencount.Lengths(public_tokenizers.path("word_bpe_49k.json"), {})


def test_pieces_equal_the_library(some_docs):
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), piecemerge.Pieces(PIECES)
    random = np.random.default_rng(2)
    alphabet = list("aethe n r s qz.,'-<>0x1  ▁é日\n")
    texts = TEXTS + ["".join(random.choice(alphabet, random.integers(1, 60))) for _ in range(3000)]
    texts += [" " * n + w for n in range(1, 80) for w in ("", "the", "日", "\n")] + [r.text for r in some_docs.collect()]
    for text in texts:
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text[:60]
        assert own.decode(packed) == library.decode(ids), text[:60]


def test_every_character_of_the_pieces():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), piecemerge.Pieces(PIECES)
    for start in range(0, 0x30000, 97):
        text = "".join(f"{chr(c)}a {chr(c)}{chr(c)}" for c in range(start, start + 97) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_long_words_take_linear_time():
    own = piecemerge.Pieces(PIECES)
    for text in ("a" * 300_000, "the" * 100_000, "\n" * 100_000, " " * 300_000, "日" * 100_000):
        assert own.decode(own.encode(text)) == text


def test_digests(spark, hard_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for r in hard_docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in piecemerge.digests(hard_docs, PIECES).collect())
    assert piecemerge.digests(no_docs, PIECES).collect() == []
    both = {r.doc_id: (r.ids, r.decoded) for r in piecemerge.encode_documents(hard_docs.where("doc_id = 1"), PIECES).collect()}
    assert both[1][1] == "The quick brown fox jumps over the lazy dog and runs away."
