"""Exact dedup against a dictionary, with and without heavy groups, and odd inputs."""

import hashlib
import random
from collections import defaultdict

import pytest

from diurna.llm.exact_dedup import digests, exact_dedup, frequent


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[normal(text)].append(doc)
    out = []
    for doc, text in rows:
        g = groups[normal(text)]
        keep = max((d for d in g if d is not None), default=None)
        out.append((doc, keep, len(g), doc is not None and doc == keep, hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(seed):
    rng = random.Random(seed)
    out = [(k, rng.choice(["Hot TEXT", "hot text"])) for k in range(300)]
    out += [(1000 + k, rng.choice(["a", "B", "b", "É", "é", "İstanbul", "ß", "straße STRASSE", "K"]) * rng.randrange(1, 3)) for k in range(200)]
    out += [(5000, None), (5001, ""), (5002, "Long " * 30000), (5003, "long " * 30000), (5003, "long " * 30000), (None, "hot text"), (None, "alone"), (1, "hot TEXT")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("winners", [1000, 2])
def test_against_a_dictionary(spark, winners):
    data = rows(winners)
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as digest", "'k' as keep_id", "2 as id").repartition(7)
    got = sorted(map(tuple, exact_dedup(docs, max_winners=winners, tracked=max(winners, 16)).collect()), key=repr)
    assert got == brute(data)


def test_winners_are_verified_and_bounded(spark):
    docs = spark.createDataFrame(rows(1), "doc_id long, text string").repartition(9)
    found = frequent(digests(docs), max_winners=1, tracked=64).collect()
    assert [(r["group_size"], r["keep_id"]) for r in found] == [(302, 299)]


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
