import zlib

import numpy as np

from deedmill.llm import langid


def test_held_out_accuracy(some_docs):
    known = {r.doc_id: r.lang for r in some_docs.collect()}
    got = langid.identify(some_docs).collect()
    assert len(got) == len(known)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in known if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.02 * len(got)


def test_hard_rows(hard_docs, no_docs):
    got = langid.identify(hard_docs).collect()
    assert len(got) == hard_docs.count()
    letters = {r.doc_id: any(c.isalpha() for c in r.text or "") for r in hard_docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not letters[r.doc_id])
        assert r.lang_pred in {"und", "en", "de", "fr"} and (r.lang_pred != "und" or (r.score == 0 and r.rejected))
    assert langid.identify(no_docs).collect() == []
    kept = langid.keep_identified(hard_docs)
    assert kept.columns == hard_docs.columns and langid.keep_identified(no_docs).collect() == []
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if not r.rejected)


def test_prediction_uses_the_text_alone(some_docs):
    model = langid.fit(some_docs)
    swapped = some_docs.selectExpr("doc_id + 1000 AS doc_id", "text", "'xx' AS lang", "'yy' AS source", "n_chars")
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(some_docs, model).collect()}
    two = {r.doc_id - 1000: (r.lang_pred, r.score) for r in langid.identify(swapped, model).collect()}
    assert one == two


def test_held_out_documents_teach_nothing(spark):
    rows = [(i, f"alpha beta gamma {i}" if i % 2 else f"uno dos tres {i}", "a" if i % 2 else "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = [(i, t, "poison" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    poisoned = spark.createDataFrame(wrong, "doc_id long, text string, lang string")
    assert langid.fit(docs).languages == langid.fit(poisoned).languages == ("a", "b")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, "more", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score, r.rejected) for r in langid.identify(docs).collect()] == [("und", 0.0, True)] * 2


def test_numerals_are_no_letters(spark, some_docs):
    texts = ["²", "½ ①", "Ⅷ", "١٢٣", "_-_", "ª", "ʰ", "ß"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.fit(some_docs)).collect()}
    assert {i for i, lang in got.items() if lang == "und"} == {i for i, t in enumerate(texts) if not any(c.isalpha() for c in t)}


def test_the_first_texts_of_each_language_are_learned_from(spark, monkeypatch):
    """The sample is what sorting whole languages gives."""
    seen = []
    monkeypatch.setattr(langid, "train", lambda bags: seen.extend(bags))
    monkeypatch.setattr(langid, "PER_LANGUAGE", 20)
    rows = [(i, f"text {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "a" if i % 3 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langid.fit(docs)
    ranked = docs.where("crc32(cast(doc_id as string)) % 4 != 2").selectExpr("text", "lang", "row_number() over (partition by lang order by xxhash64(doc_id, lang), doc_id) AS n")
    want = [(r.lang, sorted(langid.features(r.text).tolist())) for r in ranked.where("n <= 20").collect()]
    got = [(lang, np.repeat(idx, counts.astype(int)).tolist()) for lang, idx, counts in seen]
    assert sorted(got) == sorted(want)
