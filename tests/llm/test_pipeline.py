import corpus_pipeline
from deedmill.llm import langid, mixing, piecemerge, pii, registry, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, some_docs):
    docs, seen = some_docs, {"start": some_docs.count()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, None)
        if i < 4:
            assert docs.columns == COLUMNS
        docs = docs.cache()
        seen[name] = docs.count()
        if name == "language":
            assert {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()} == {r.doc_id for r in langid.identify(before).collect() if r.rejected}
        if name == "near_duplicates":
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in simhash.query(before).collect()}
        if name == "personal_data":
            for r in docs.collect():
                assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
            clean = {r.doc_id for r in pii.find(before).collect() if not r.spans}
            old = {r.doc_id: r.text for r in before.collect()}
            assert all(r.text == old[r.doc_id] for r in docs.collect() if r.doc_id in clean)
        if name == "mixture":
            assert sorted(map(str, docs.collect())) == sorted(map(str, before.collect()))
        if name == "pieces":
            slots = mixing.query(before).select("doc_id", "slot").collect()
            assert sorted(map(tuple, slots)) == sorted(map(tuple, docs.select("doc_id", "slot").collect()))
    assert seen["start"] >= seen["language"] > seen["near_duplicates"] == seen["personal_data"] == seen["mixture"] == seen["pieces"]


def test_run_equals_the_stages(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "slot"]


def test_hard_rows_and_empty_table(spark, hard_docs, no_docs):
    for docs in (hard_docs, no_docs):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, None)
            if i < 4:
                assert docs.columns == hard_docs.columns
        docs.collect()


def test_pieces_follow_the_order_of_the_mix(spark, some_docs, tmp_path):
    def slots(docs):
        return {r.doc_id: r.slot for r in corpus_pipeline.pieces(spark, docs, None).collect()}

    want = {r.doc_id: r.slot for r in mixing.query(some_docs).collect()}
    # Several files, the first of which is the smallest: readers take large files first.
    corpus_pipeline.mixture(spark, some_docs, None).write.option("maxRecordsPerFile", 30).parquet(f"{tmp_path}/mixed")
    other = some_docs.coalesce(1).orderBy("doc_id")
    other.write.parquet(f"{tmp_path}/other")
    assert slots(spark.read.parquet(f"{tmp_path}/mixed")) == want
    assert slots(spark.read.parquet(f"{tmp_path}/other")) == slots(other) != want


def test_registered():
    names = list(registry.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixture", "pieces"]
    assert [n.split("_")[0] for n in names[:-1]] == [f"op{i}" for i in range(1, 14)] and names[-1] == "pipeline"
    assert piecemerge.BLANK == "▁"
