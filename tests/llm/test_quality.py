"""Positive-unlabelled quality classifier: held-out accuracy, prior, and odd inputs."""

import random

import numpy as np

from diurna.llm import quality


def texts(n, seed):
    """(text, label): prose or one of three kinds of junk, a fifth of all."""
    rng = random.Random(seed)
    words = ["alder", "birch", "cedar", "elm", "fir", "hazel", "of", "the", "and", "in", "oak", "pine", "rowan", "willow", "yew"]
    out = []
    for _ in range(n):
        k = rng.randrange(20, 300)
        body = [rng.choice(words) for _ in range(k)]
        kind = rng.random()
        if kind < 0.07:
            out.append((" ".join(w.upper() + "!!" for w in body), 0))
        elif kind < 0.14:
            out.append((" | ".join(body), 0))
        elif kind < 0.2:
            out.append((" ".join([body[0]] * k), 0))
        else:
            out.append((" ".join(body).capitalize() + ".", 1))
    return out


def test_prior_and_held_out_accuracy():
    train, rest = texts(3000, 1), texts(1000, 2)
    x = np.array([quality.features(t) for t, _ in train])
    y = np.array([label for _, label in train])
    prior = quality.class_prior(x[y == 1][:1000], x[1000:])
    assert 0.65 < prior < 0.9
    model = quality.fit(x[y == 1][:1000], x[1000:])
    score = model.score(np.array([quality.features(t) for t, _ in rest]))
    assert np.mean((score >= 0.5) == np.array([label for _, label in rest])) > 0.97


def test_query(spark):
    rows = [(k, t, label) for k, (t, label) in enumerate(texts(2400, 3))]
    rows += [(9000, None, 1), (9001, "", 1), (9002, "word " * 60000, 0), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int").selectExpr("doc_id", "text", "'x' as score", "1 as kind", "2 as id")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:1600]] + [(20000, 1), (None, 1), (3, None)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = {r["doc_id"]: r["predicted"] for r in got if r["held_out"]}
    truth = {r[0]: r[2] for r in rows[:2400]}
    assert np.mean([p == truth[d] for d, p in held.items() if d in truth]) > 0.9
    assert quality.classify(docs, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality.classify(docs.limit(0), labels).count() == 0
