import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tiersmith.llm import subword_quality as quality
from tiersmith.llm.textcodes import slices

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").selectExpr("doc_id", "quality AS label")
    model = quality.learn(docs, labels.where(~quality.held_out()))
    scored = quality.score_documents(docs, model, 0.3).join(labels, "doc_id").where(quality.held_out())
    right, total = scored.agg(F.expr("count_if(predicted = label)"), F.count("*")).first()
    assert total > 50 and right / total > 0.97
    again = quality.score_documents(docs, quality.learn(docs, labels.where(~quality.held_out())), 0.3)
    assert again.exceptAll(quality.score_documents(docs, model, 0.3)).count() == 0


def test_features_stay_within_texts_and_words():
    texts = ["abc abc abd", "", "xy", None, "abc abc abd", "é z"]
    groups = quality.features(next(slices(pa.array(texts))))
    bags = [np.sort(np.concatenate([found[first[d] : first[d + 1]] for found, first in groups])) for d in range(len(texts))]
    alone = [quality.features(next(slices(pa.array([t], pa.string())))) for t in texts]
    for d, own in enumerate(alone):
        assert bags[d].tolist() == sorted(np.concatenate([found for found, _ in own]).tolist())
    assert bags[0].tolist() == bags[4].tolist() and len(bags[1]) == len(bags[3]) == 0
    # Three words, one repeat, and windows of three and four bytes: 'abc', 'bc ', ' ab', ...
    assert [len(first) - 1 for _, first in groups] == [len(texts)] * 4
    assert [int(first[1]) for _, first in groups] == [3, 1, 7, 4]


def test_odd_rows_and_few_labels(make, odd_rows, spark):
    docs = make(odd_rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (6, None), (None, 1), (99, 0)], "doc_id long, label int")
    model = quality.learn(docs, labels)
    rows = quality.score_documents(docs, model, 0.3).collect()
    assert len(rows) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1


def test_nothing_to_learn_and_empty_table(make, spark):
    labels = spark.createDataFrame([], "doc_id long, label int")
    model = quality.learn(make([(1, "a")]), labels)
    assert [r.score for r in quality.score_documents(make([(1, "a"), (2, None)]), model, 0.3).collect()] == [0.5, 0.5]
    assert quality.score_documents(make([]), model, 0.3).count() == 0


def test_the_sample_is_bounded(make, spark):
    docs = make([(i, f"word{i % 5} text") for i in range(60)])
    labels = spark.range(60).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS label")
    seen = []
    original, quality.train = quality.train, lambda bags: seen.append(len(bags)) or original(bags)
    try:
        quality.learn(docs, labels, sample=25)
    finally:
        quality.train = original
    assert seen == [25]


def test_training_separates_two_kinds():
    draw = random.Random(1)
    texts = [" ".join(draw.choice(["apple", "pear", "plum"] if i % 2 else ["###", "$$$", "APPLE"]) for _ in range(40)) for i in range(200)]
    bags = []
    for i, text in enumerate(texts):
        groups = quality.features(next(slices(pa.array([text]))))
        ids, counts = np.unique(np.concatenate([f for f, _ in groups]), return_counts=True)
        bags.append((i % 2, len(ids), quality.pack_bag(ids, counts)))
    model = quality.train(bags)
    scores = np.concatenate([model.scores(p) for p in slices(pa.array(["apple plum pear", "### APPLE $$$"]))])
    assert scores[0] > 0.9 and scores[1] < 0.1
