"""Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from diurna.llm import jaccard_join as jj


def shingles(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """{id: (class_id, copy_id, n_copies, n_links)}"""
    words = {d: tuple(re.findall(r"\w+", (t or "").lower())) for d, t in rows}
    copies = {}
    for d, w in words.items():
        copies.setdefault(w, []).append(d)
    reps = {min(ds): shingles(" ".join(w)) for w, ds in copies.items()}
    links = {r: {q for q in reps if q != r and reps[q] and reps[r] and len(reps[r] & reps[q]) >= 0.8 * len(reps[r] | reps[q])} for r in reps}
    group = {}
    for r in sorted(reps):
        if r not in group:
            todo = [r]
            while todo:
                x = todo.pop()
                if x not in group:
                    group[x] = r
                    todo += links[x]
    return {d: (group[min(copies[w])], min(copies[w]), len(copies[w]), len(links[min(copies[w])])) for d, w in words.items()}


def corpus(seed, groups=12, size=14):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    boiler = " ".join(rng.choices(vocabulary, k=12))
    rows = [(1, None), (2, ""), (3, "..."), (4, "two words"), (5, "Two, WORDS!"), (6, "two words more"), (7, "x " * 40000)]
    doc = 10
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([9, 60, 200, 400]))
        for _ in range(rng.randrange(1, size)):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(copy) + (". " + boiler if rng.random() < 0.3 else "")))
            doc += 1
    return rows


@pytest.mark.parametrize("small", [jj.SMALL, 4])
def test_against_all_pairs(spark, monkeypatch, small):
    if small == 4:  # deep recursion and several blocks
        monkeypatch.setattr(jj, "BLOCK", 5)
        monkeypatch.setattr(jj, "NODE_BLOCK", 6)
        monkeypatch.setattr(jj.leaves, "__defaults__", (4, jj.SIMILARITY))
    rows = corpus(7 + small)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' as key", "2 as node", "3 as id")
    got = {r["doc_id"]: tuple(r)[1:] for r in jj.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for d in range(300):
        copy = list(base)
        copy[rng.randrange(150)] = f"n{d}"
        rows.append((d, " ".join(copy)))
    got = {r["doc_id"]: tuple(r)[1:] for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_large_linked_sets_are_compared_inside_their_nodes(spark, monkeypatch):
    monkeypatch.setattr(jj, "WHOLE", 10)
    monkeypatch.setattr(jj, "BLOCK", 30)
    monkeypatch.setattr(jj.leaves, "__defaults__", (40, jj.SIMILARITY))
    rng = random.Random(12)
    rows = []
    for g, size in enumerate((160, 40, 8)):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(150)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(150)] = f"n{rng.randrange(100)}"
            rows.append((len(rows), " ".join(copy)))
    expected = brute(rows)
    assert max(e[3] for e in expected.values()) > 60
    got = {r["doc_id"]: tuple(r)[1:] for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def pair(rng, words, k):
    """Two texts of about so many words, with a similarity of 0.8 or just above; None if the dice give another."""
    base = [f"p{k}w{j}" for j in range(words)]
    copy = list(base)
    while True:
        at = rng.choice([0, len(copy) - 1, rng.randrange(len(copy))])
        trial = list(copy)
        trial[at] = f"p{k}x{rng.randrange(10**9)}"
        if len(shingles(" ".join(base)) & shingles(" ".join(trial))) < 0.8 * len(shingles(" ".join(base)) | shingles(" ".join(trial))):
            break
        copy = trial
    a, b = shingles(" ".join(base)), shingles(" ".join(copy))
    return (" ".join(base), " ".join(copy)) if copy != base and len(a & b) <= 0.9 * len(a | b) else None


def test_recall_at_the_bound(spark):
    """Pairs at the similarity or just above it, by length; small nodes, so that the recursion goes deep."""
    rng, rows, kinds = random.Random(14), [], {}
    for words in (14, 16, 20, 45, 200):
        made = 0
        while made < 150:
            texts = pair(rng, words, len(rows))
            if texts:
                kinds[len(rows)] = words
                rows += [(len(rows), texts[0]), (len(rows) + 1, texts[1])]
                made += 1
    got = {r["doc_id"]: r["n_links"] for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for words in (14, 16, 20, 45, 200):
        found = [got[d] > 0 for d, w in kinds.items() if w == words]
        assert np.mean(found) >= 0.99, words


def test_runs_follow_from_the_target_recall():
    for depth in (1, 2, 4):
        rng, missed, runs = random.Random(depth), 0, jj.repeats(depth, missed=0.01)
        for _ in range(20_000):
            def together(d):
                return d == 0 or any(rng.random() < 0.8 and together(d - 1) for _ in range(max(1, np_poisson(rng))))

            missed += not any(rng.random() < 0.8 and together(depth - 1) for _ in range(runs))
        assert missed <= 0.015 * 20_000, (depth, missed)


def np_poisson(rng, mean=1.25):
    limit, n, p = 2.718281828 ** -mean, 0, rng.random()
    while p > limit:
        n, p = n + 1, p * rng.random()
    return n


def test_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, "q r s")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["class_id"], r["n_copies"]) for r in jj.near_duplicates(docs).collect())
    assert got == [(0, None, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert jj.near_duplicates(docs.limit(0)).count() == 0


def test_short_texts_edited_at_their_ends(spark):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        n = rng.randrange(9, 61)
        base = [f"g{k}w{j}" for j in range(n)]
        edits = rng.randrange(1, 1 + max(1, (n - 4) // 9))
        copy = base[edits:] if rng.random() < 0.3 else base[:-edits] + [f"g{k}n{j}" for j in range(edits if rng.random() < 0.5 else 0)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    rows += [(2000 + k, " ".join(f"t{k // 2}w{j}" for j in range(5 + k % 2))) for k in range(20)]
    expected = brute(rows)
    assert sum(e[3] > 0 for e in expected.values()) > 800
    got = {r["doc_id"]: tuple(r)[1:] for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def test_estimate_of_small_sets():
    rng = random.Random(6)
    shared = {5: 4, 8: 7, 10: 8, 20: 16, 100: 80}
    least = jj.least_equal()
    for union, both in shared.items():
        for _ in range(2000):
            drawn = [rng.getrandbits(64) for _ in range(union)]
            a = np.array(drawn[:both] + drawn[both :: 2], np.uint64)
            b = np.array(drawn[:both] + drawn[both + 1 :: 2], np.uint64)
            assert (jj.tokens(np.sort(a)) == jj.tokens(np.sort(b))).sum() >= least
