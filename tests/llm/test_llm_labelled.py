import numpy as np
from pyspark.sql import functions as F

from moldwise.llm import labelled, language, quality, toxicity
from moldwise.llm.textbytes import is_fold


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, toxic int")
    return docs.select("doc_id", "text", "lang"), docs.select("doc_id", "quality", "toxic")


def sample(docs, labels, *bounds):
    targets = labels.select("doc_id", F.col("quality").alias("label"))
    return labelled.bounded_sample(docs, targets, 4, 2, *bounds).collect()


def test_null_texts_are_replaced(spark):
    docs, labels = documents(spark, [(i, f"text {i}" if i % 3 == 0 else None, "en", 1, 0) for i in range(300)])
    want = [r["doc_id"] for r in docs.where(F.col("text").isNotNull() & ~is_fold(F.col("doc_id"), 4, 2)).orderBy(F.xxhash64("doc_id")).limit(20).collect()]
    assert sorted(r["doc_id"] for r in sample(docs, labels, 20, 1000, 100000)) == sorted(want)


def test_long_texts_give_excerpts(spark):
    long = [" ".join(f"w{i}x{j}" for j in range(400 * (i + 1))) for i in range(40)]
    docs, labels = documents(spark, [(i, t, "en", 1, 0) for i, t in enumerate(long)] + [(100 + i, "é" * 4000, "en", 0, 0) for i in range(9)])
    every = {r["doc_id"] for r in docs.where(~is_fold(F.col("doc_id"), 4, 2)).collect()}
    got = {r["doc_id"]: r["text"] for r in sample(docs, labels, 100, 10000, 100000)}
    assert set(got) == every
    sizes = {i: len(t.encode()) for i, t in got.items()}
    assert max(sizes.values()) <= 10000 and 70000 < sum(n for i, n in sizes.items() if i < 40) <= 100000
    for i, text in got.items():
        if i < 40:  # whole words of all parts of the text
            assert text == long[i] or set(text.split()) <= set(long[i].split()) and text.startswith(long[i][:9]) and text.endswith(long[i][-9:])
    assert any(got[i] == long[i] for i in got if i < 40)


def test_models_learn_from_long_texts_alone(spark):
    rng = np.random.default_rng(4)
    say = lambda stem: " ".join(stem + "abcdefgh"[k] for k in rng.integers(0, 8, 7)) + ". "
    rows = []
    for i in range(80):
        stem = ("lor", "zuk")[i % 2]
        text = "".join(say(stem) for _ in range(1400))  # over 40,000 bytes
        rows.append((i, text + ("vile deed. " if i % 2 else "") + say(stem), ("en", "de")[i % 2], i % 2, i % 2))
    docs, labels = documents(spark, rows)
    assert language.train(docs).langs == ["de", "en"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.language_report(docs).collect()}
    assert all(got[i] == ("en", "de")[i % 2] for i in got)
    got = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, labels).collect()}
    assert all((got[i] >= 0.5) == i % 2 for i in got)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, labels).collect()}
    assert all((got[i] >= 0.5) == i % 2 for i in got)


def test_smallest_ranks_few_rows(spark):
    rows = spark.range(60000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 == 0).cast("int").alias("label"))
    want = {r["doc_id"] for label in (0, 1) for r in rows.where(F.col("label") == label).orderBy(F.xxhash64("doc_id")).limit(1500).collect()}
    assert sorted(r["doc_id"] for r in labelled.smallest(rows, 1500).collect()) == sorted(want)
    few = {r["label"]: r["count"] for r in labelled.first_ranges(rows, 1500).groupBy("label").count().collect()}
    assert few[1] == 1200 and 1500 <= few[0] <= 1530  # of 58800
