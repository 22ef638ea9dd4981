import numpy as np
from pyspark.sql import functions as F

from rejoinder.llm import toxicity
from tests.llm.conftest import TEXTS


def area(rows):
    good, bad = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs.select("doc_id", "text"), labels))
    rows = scored.join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).select("score", "toxic").collect()
    assert area(rows) > 0.93


def test_labels_of_the_held_out_fifth_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_label_model_finds_good_voters():
    rng = np.random.default_rng(2)
    truth = rng.random(2000) < 0.3
    good = [np.where(rng.random(2000) < 0.9, truth, ~truth) for _ in range(4)]
    noise = rng.random(2000) < 0.5
    votes = np.array([*(np.where(g, 1, -1) for g in good), *[np.where(noise, 1, 0)] * 12]).T.astype(float)
    posterior = toxicity.label_model(votes, np.ones(2000), 0.3)
    assert ((posterior > 0.5) == truth).mean() > 0.93


def test_rows_and_columns(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.drop_toxic(odd_docs, model)
    assert kept.schema == odd_docs.schema and kept.count() == len(TEXTS)
    assert toxicity.score(no_docs, toxicity.train(no_docs, labels.limit(0))).collect() == []


def test_without_labels_insults_decide(spark, odd_docs):
    model = toxicity.train(odd_docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.score("you are an idiot") > 0.5 > model.score("a calm text")
    docs = spark.createDataFrame([(1, "you idiot"), (2, "calm")], "doc_id long, text string")
    assert [r.doc_id for r in toxicity.drop_toxic(docs, model).collect()] == [2]
