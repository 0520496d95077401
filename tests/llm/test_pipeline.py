import corpus_pipeline
from factloom.llm import exact_dedup, language_id, ngram_join, packing, toxicity
from factloom.llm.common import stored

import public_tokenizers


def test_stages_are_the_operators_one_after_another(spark, medium):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "exact_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    columns, ids, seen = docs.columns, {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen
        seen = stored(spark, stage(spark, seen, medium), name)
        assert seen.columns == columns
        assert seen.exceptAll(before).count() == 0  # rows go, none changes
        ids[name] = {r["doc_id"] for r in seen.select("doc_id").collect()}
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    found = language_id.identify(docs, language_id.train(language_id.training_rows(docs))).collect()
    assert ids["language"] == {r["doc_id"] for r in found if r["lang_pred"] != "und" and r["score"] >= 0.4}
    model = toxicity.train(docs, toxicity.training_labels(labels))
    clean = {r["doc_id"] for r in toxicity.score(docs, model).collect() if not r["predicted"]}
    assert ids["toxicity"] == ids["language"] & clean
    left = docs.filter(docs["doc_id"].isin(*ids["toxicity"]))
    kept = {r["doc_id"] for r in exact_dedup.find_copies(left).collect() if r["kept"]}
    assert ids["exact_dedup"] == kept
    left = docs.filter(docs["doc_id"].isin(*kept))
    near = ngram_join.near_copies(left).collect()
    assert ids["near_dedup"] == {r["doc_id"] for r in near if r["doc_id"] == r["component_id"]}
    left = docs.filter(docs["doc_id"].isin(*ids["near_dedup"]))
    expected = packing.pack(left, public_tokenizers.path("byte_bpe_50k.json"))
    result = corpus_pipeline.run(spark, medium)
    assert result.columns == expected.columns
    what = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, result.select(what).collect())) == sorted(map(tuple, expected.select(what).collect()))


def test_stages_of_odd_and_no_rows(spark, medium, odd_documents, no_documents):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd_documents, medium)
        assert out.columns == odd_documents.columns, name
        assert out.exceptAll(odd_documents).count() == 0, name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents, medium).count() == 0, name
