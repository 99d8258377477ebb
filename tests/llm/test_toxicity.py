"""Toxicity: exact neighbours against all cosines, held-out accuracy, and odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from diurna.llm import toxicity as tx


def plain_index(examples):
    """(weights by term, vectors) from the formulas."""
    n, bad = len(examples), sum(t for _, _, t in examples)
    df = Counter(t for _, v, _ in examples for t in v)
    weights = {}
    for t, d in df.items():
        if d < 2:
            continue
        a = sum(toxic for _, v, toxic in examples if t in v)
        chi2 = n * (a * (n - bad - d + a) - (d - a) * (bad - a)) ** 2 / (d * (n - d) * bad * (n - bad)) if d < n else 0.0
        weights[t] = (math.log((n + 1) / (d + 1)) + 1) * max(0.0, chi2 / n - 1 / (n - 1))

    def vector(counts):
        x = {t: (1 + math.log(c)) * weights[t] for t, c in counts.items() if weights.get(t)}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {t: v / norm for t, v in x.items()} if norm else {}

    return vector, [vector(v) for _, v, _ in examples]


def plain_share(query, examples, k):
    vector, vectors = plain_index(examples)
    q = vector(query)
    cosine = [sum(x * v.get(t, 0.0) for t, x in q.items()) for v in vectors]
    ranked = sorted((c for c in range(len(examples)) if cosine[c] > 1e-5), key=lambda c: -cosine[c])
    held, near = 0, []
    for c in ranked:
        if held >= k and cosine[c] < cosine[near[-1]] - 1e-6:
            break
        near.append(c)
        held += 1
    votes = [sum((cosine[c] / cosine[near[0]]) ** 2 for c in near if examples[c][2] == kind) for kind in (True, False)]
    return (votes[0] / sum(votes), max(cosine)) if near else (None, 0.0)


def as_arrays(counts):
    return np.array([tx.number(t) for t in counts], np.uint64), np.array(list(counts.values()), np.int64)


@pytest.mark.parametrize(("block", "step", "few"), [(tx.BLOCK, tx.STEP, tx.FEW), (2, 1, 12), (4, 3, 0)])
def test_votes_against_all_cosines(monkeypatch, block, step, few):
    monkeypatch.setattr(tx, "BLOCK", block)
    monkeypatch.setattr(tx, "STEP", step)
    monkeypatch.setattr(tx, "FEW", few)
    rng = random.Random(4)
    words = [f"t{k}" for k in range(40)]
    vector = lambda bad: {t: rng.randrange(1, 5) for t in rng.choices(words[: 20 if bad else 40], k=rng.randrange(0, 9))}
    examples = [(f"{k:03}", vector(k % 3 == 0), k % 3 == 0) for k in range(200)]
    index = tx.Index([(i, as_arrays(v), t) for i, v, t in examples], 1.0, 2.5)
    place = {h: k for k, h in enumerate(index.vocabulary.tolist())}
    for _ in range(60):
        query = vector(rng.random() < 0.5)
        known = {t: c for t, c in query.items() if tx.number(t) in place}
        share, _, cosine = index.share(np.array([place[tx.number(t)] for t in known], np.int64), np.array(list(known.values()), np.int64))
        want, best = plain_share(query, examples, 10)
        assert (share is None) == (want is None)
        assert want is None or (abs(share - want) < 1e-4 and abs(cosine - best) < 1e-4)


def test_common_words_are_not_read(monkeypatch):
    """Blocks of lists that add little stay unread."""
    rng = random.Random(9)
    examples = [(f"{k:04}", as_arrays({f"c{j}": 1 for j in rng.sample(range(60), 30)} | ({f"bad{k % 7}": 3} if k % 5 == 0 else {})), k % 5 == 0) for k in range(3000)]
    index, read = tx.Index(examples), []
    monkeypatch.setattr(tx, "_ranges", lambda start, end, plain=tx._ranges: read.append(int((end - start).sum())) or plain(start, end))
    place = {h: k for k, h in enumerate(index.vocabulary.tolist())}
    terms = [place[x] for t in ["bad3", *(f"c{j}" for j in range(40))] if (x := tx.number(t)) in place]
    index.share(np.array(terms), np.ones(len(terms), np.int64))
    assert read[0] < 0.7 * sum(index.start[t + 1] - index.start[t] for t in terms)


def test_reader_finds_all_terms():
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(["Word", "wordy", "other", "ab", "x9", "wordsmith"], k=rng.randrange(0, 300)))
    names = sorted({t for _ in range(20) for t in tx.text_terms(text())})[::2]
    reader = tx.Reader(names)
    for _ in range(50):
        t = text()
        terms, counts = reader(t)
        assert {names[k]: c for k, c in zip(terms.tolist(), counts.tolist(), strict=True)} == {x: c for x, c in tx.text_terms(t).items() if x in set(names)}
    assert tx.text_terms(None) == {} and len(reader(None)[0]) == 0


def test_isotonic():
    shares, toxic = np.array([0.0, 0.2, 0.2, 0.5, 0.9, 0.9, 1.0]), np.array([0, 1, 0, 0, 1, 1, 1.0])
    x, p = tx.isotonic(shares, toxic, np.ones(7), 0.3)
    assert (np.diff(x) > 0).all() and (np.diff(p) >= 0).all() and p.min() > 0 and p.max() < 1
    assert np.interp(0.3, x, p) < 0.5 < np.interp(0.95, x, p)


def world(n, seed):
    rng = random.Random(seed)
    plain = [f"plain{chr(97 + k % 26)}{k}" for k in range(200)]
    bad = ["awful", "vileness", "nastyword", "horridly"]
    rows = []
    for k in range(n):
        words = rng.choices(plain, k=rng.randrange(5, 120))
        toxic = rng.random() < 0.12
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad).capitalize())
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_query(spark):
    rows = world(1500, 1)
    extra = [(5000, None), (5001, ""), (5002, "plaina0 " * 50000 + "awful vileness"), (3, rows[3][1])]
    docs = spark.createDataFrame([r[:2] for r in rows] + extra, "doc_id long, text string").selectExpr("*", "1 as toxic", "'s' as term", "2 as id")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:1200]] + [(None, 1), (7, None), (99999, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in tx.toxicity(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    truth = {r[0]: r[2] for r in rows}
    wrong = [d for d, r in got.items() if r["held_out"] and d in truth and r["predicted"] != truth[d]]
    assert len(wrong) <= 0.02 * len(rows)
    assert got[5000]["score"] == got[5001]["score"] < 0.2 and got[5002]["score"] > 0.7
    assert got[5002]["nearest_id"] is not None and got[5000]["nearest_id"] is None
    assert tx.toxicity(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert tx.toxicity(docs.limit(0), labels).count() == 0


def test_text_ids_and_repeated_ids(spark):
    rows = [(f"d{k}", t, y) for k, t, y in world(600, 2)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(rows[0][0], "z " * k) for k in range(500)], "doc_id string, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id string, toxic int")
    sample, toxic, clean = tx.labelled(docs, labels, "doc_id", "text", "toxic", 20, 30)
    assert sample.count() == 50 and toxic > 20 and clean > 30
    got = tx.toxicity(docs, labels)
    assert dict(got.dtypes)["nearest_id"] == "string" and got.count() == len(rows) + 500
