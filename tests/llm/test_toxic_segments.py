import random

import numpy as np
from pyspark.sql import functions as F

from tiersmith.llm import toxic_segments as toxic
from tiersmith.llm.subword_quality import held_out

SF_DIR = "/root/testdata/sf0.01"


def all_maximal(scores):
    """Maximal segments by their definition: the best segment, and the same on both sides of it."""
    if not len(scores):
        return []
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and b - a < best[1] - best[0] - 1):
                best = (a, b + 1, total)
    if best[2] <= 0:
        return []
    a, b, _ = best
    right = [(x + b, y + b, s) for x, y, s in all_maximal(scores[b:])]
    return [*all_maximal(scores[:a]), best, *right]


def test_segments_equal_their_definition():
    draw = random.Random(5)
    for _ in range(300):
        scores = np.array([draw.choice([-2.3, -1.1, -0.7, 0.9, 1.6, 2.9]) + draw.random() / 100 for _ in range(draw.randrange(1, 14))])
        got = [(a, b, round(s, 6)) for a, b, s in toxic.maximal_segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in all_maximal(scores.tolist())], scores
        assert abs(toxic._largest(scores) - max((s for *_, s in got), default=0)) < 1e-5


def test_extreme_values_are_fitted():
    draw = np.random.default_rng(2)
    n = draw.integers(50, 5000, 20_000)
    sums = (np.log(0.05 * n) - np.log(-np.log(draw.random(20_000)))) / 1.7
    rate, scale = toxic.fit_extremes(sums, n)
    keep = (sums > 0).mean()
    assert keep > 0.95 and abs(rate - 1.7) < 0.1 and abs(scale - 0.05) < 0.02


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").selectExpr("doc_id", "toxic AS label")
    scorer = toxic.learn(docs, labels.where(~held_out()))
    scored = toxic.score_documents(docs, scorer).join(labels, "doc_id").where(held_out())
    right, total, wrong = scored.agg(
        F.expr("count_if(predicted = label)"), F.count("*"), F.expr("count_if(predicted = 1 AND label = 0)")
    ).first()
    assert total > 50 and right / total > 0.95 and wrong <= 1
    passages = toxic.toxic_passages(docs, scorer).join(labels, "doc_id")
    assert passages.where("label = 1").count() > passages.where("label = 0").count()


def planted(n=400):
    draw = random.Random(3)
    words = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu") for b in ("na", "re", "si", "to", "vu")]
    rows, labels = [], []
    for i in range(n):
        text = [draw.choice(words) for _ in range(draw.randrange(40, 200))]
        if i % 5 == 0:
            at = draw.randrange(len(text))
            text[at:at] = [draw.choice(["vile", "scumbag", "trashy"]) for _ in range(3)]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_passages_are_found_where_they_are(make, spark):
    rows, labels = planted()
    docs = make(rows)
    scorer = toxic.learn(docs, spark.createDataFrame(labels, "doc_id long, label int"))
    new = make([(1, "bana dere kisi " * 20 + "vile trashy scumbag lona"), (2, "bana kisi loto muvu " * 30), (3, "vile scumbag trashy")])
    scored = {r.doc_id: r for r in toxic.score_documents(new, scorer).collect()}
    assert [scored[i].predicted for i in (1, 2, 3)] == [1, 0, 1]
    found = {r.doc_id: r.passage for r in toxic.toxic_passages(new, scorer).collect()}
    assert found[1] == "vile trashy scumbag" and 2 not in found


def test_a_repeated_insult_is_found_in_a_long_text(make, spark):
    rows, labels = planted()
    scorer = toxic.learn(make(rows), spark.createDataFrame(labels, "doc_id long, label int"))
    draw = random.Random(8)
    words = [f"{a}{b}" for a in ("ba", "de", "ki", "lo", "mu") for b in ("na", "re", "si", "to", "vu")]
    before, after = (" ".join(draw.choice(words) for _ in range(10_000)) for _ in range(2))
    repeated = {1: " ".join(["scumbag"] * 8), 2: " ".join(["vile"] * 8), 3: "trashy" + " bana trashy" * 11}
    clean = {4: "lona lona lona", 5: " ".join(["muvu"] * 200)}
    new = make([(i, f"{before} {text} {after}") for i, text in {**repeated, **clean}.items()])
    scored = {r.doc_id: r.predicted for r in toxic.score_documents(new, scorer).collect()}
    assert scored == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
    assert {r.doc_id: r.passage for r in toxic.toxic_passages(new, scorer).collect()} == repeated


def test_odd_rows(make, odd_rows, spark):
    rows, labels = planted(100)
    docs = make(rows)
    scorer = toxic.learn(docs, spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, label int"))
    odd = make(odd_rows)
    got = toxic.score_documents(odd, scorer).collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    least = min(r.score for r in got)
    assert all(r.score == least for r in got if r.doc_id in (3, 4, 5))
    assert toxic.toxic_passages(make([]), scorer).count() == 0


def test_nothing_to_learn(make, spark):
    scorer = toxic.learn(make([]), spark.createDataFrame([], "doc_id long, label int"))
    rows = toxic.score_documents(make([(1, "some text"), (2, None)]), scorer).collect()
    assert all(r.predicted == 0 for r in rows)
    assert toxic.score_documents(make([]), scorer).count() == 0
