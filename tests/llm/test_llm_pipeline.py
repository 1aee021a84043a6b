import corpus_pipeline
from test_llm_pairs import plain_components, plain_hits

from moldwise.llm import quality, registry, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(2)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, SF)
    good = {r["doc_id"] for r in quality.quality_report(docs, labels).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == docs.columns
    clean = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in toxicity.toxicity_report(docs, labels).collect() if not r["predicted"]}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    single = corpus_pipeline.one_of_near_copies(spark, docs, SF)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, _, c in plain_components(rows) if d == c) and single.columns == docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in plain_hits(rows, items) if not r[5]} and left.columns == docs.columns


def test_run_equals_stages_in_order(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()} and all(r["decoded"] for r in got)


def test_stages_of_odd_and_no_rows(spark, edge_docs, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, edge_docs, SF).collect()
        assert stage(spark, no_docs, SF).count() == 0


def test_registered_queries():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14)) and set(registry.SQL) <= set(registry.QUERIES)
