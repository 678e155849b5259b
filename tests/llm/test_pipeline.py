import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from colloquy.llm import decontam, pii, quality
from tests.llm.conftest import SF
from tests.llm.test_ngram_join import brute


def test_pipeline_equals_plain_stages(spark):
    sf = SF
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r["doc_id"] for r in quality.score(frame, labels).where("keep = 1").collect()}
    groups = brute([(i, docs[i]["text"]) for i in good], corpus_pipeline.NEAR)
    one = {d for d, n, c in groups if d == c}
    items = [decontam.shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {i for i in one if not any(10 * len(s & decontam.shingles(docs[i]["text"])) >= 8 * len(s) for s in items if s)}
    assert len(docs) > len(good) > len(one) >= len(clean) > 0
    model = pii.fit(frame.where(frame["doc_id"].isin(list(clean))))
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i in clean:
        text = pii.mask(docs[i]["text"], pii.all_spans(docs[i]["text"], model)[1])
        want[i] = tok.encode(text, add_special_tokens=False).ids
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_stages_keep_the_columns_on_empty_and_odd_input(spark, docs_of):
    for rows in ([], [(1, None), (None, ""), (2, "one word"), (2, "one word")]):
        docs = docs_of(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            after.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == ["doc_id", "ids"]


def test_stages_keep_columns_named_like_helpers(spark):
    helpers = ["_id", "_key", "_before", "own_id", "own_key", "BEFORE", "key", "component_id", "found_id"]
    rows = [(1, "write to me at bob@example.com " + "w " * 60, *helpers), (1, "write to me at bob@example.com " + "w " * 60, *helpers),
            (None, "another text", *helpers)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{h}` string" for h in helpers))
    for stage in (corpus_pipeline.keep_one_of_each, corpus_pipeline.remove_benchmark, corpus_pipeline.mask_personal_data):
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        assert all(r[h] == h for r in after.collect() for h in helpers)
