"""Decontamination against scoring every passage with every item."""

import math
import random
from collections import Counter

from diurna.llm import decontamination as dc


def brute(items, words, segment):
    """{(passage, item position): score} for every passage of one text, from the BM25 formula."""
    items = [dc.words_of(t) for _, t in items]
    n, mean = len(items), sum(map(len, items)) / len(items)
    df = Counter(w for x in items for w in set(x))
    out = {}
    pieces = max(1, -(-len(words) // segment))
    for p in range(max(1, pieces - 1)):
        at = set(words[p * segment : (p + 2) * segment])
        for k, x in enumerate(items):
            own = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(x) / mean)) for w, f in Counter(x).items()}
            out[p, k] = sum(v for w, v in own.items() if w in at) / sum(own.values())
    return out


def world(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights=[1 / (k + 3) for k in range(300)], k=n))
    return rng, text, [(k, text(rng.randrange(12, 40)).capitalize() + ". " + text(6) + ".") for k in range(45)]


def test_retrieval_is_whole(monkeypatch):
    rng, text, items = world(1)
    texts = [text(rng.randrange(0, 400)) for _ in range(60)]
    for k in range(0, 60, 3):
        texts[k] = " ".join([*texts[k].split()[:5], items[k % 45][1], *texts[k].split()[5:]])
    for block, cells in ((1, dc.CHUNK_CELLS), (8, 500), (64, dc.CHUNK_CELLS)):
        monkeypatch.setattr(dc, "CHUNK_CELLS", cells)
        index = dc.Index(items, block=block)
        index.segment = 50
        for threshold in (0.3, 0.6):
            got = {(t, p, i): s for t, p, i, s in dc.search(index, [index.read(t) for t in texts], threshold)}
            want = {(t, p, i): s for t, x in enumerate(texts) for (p, i), s in brute(items, dc.words_of(x), 50).items() if s >= threshold}
            assert got.keys() == want.keys() and got
            assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_blocks_are_passed_unread(monkeypatch):
    _, text, items = world(4)
    index, scored = dc.Index(items, block=1), []
    monkeypatch.setattr(dc.Index, "scores", lambda self, terms, block, plain=dc.Index.scores: scored.append(block) or plain(self, terms, block))
    found = list(dc.search(index, [index.read(items[7][1]), index.read(text(60))], 0.9))
    assert [f[2] for f in found] == [7] and len(scored) < 5


def test_reading_in_slices(monkeypatch):
    _, text, items = world(5)
    index = dc.Index(items)
    whole = "\n".join([text(300), "ΑΣ ΣΑ İx", items[3][1]])
    words = [index.terms.get(w, len(index.terms)) for w in dc.words_of(whole)]
    for size in (1, 7, 100):
        monkeypatch.setattr(dc, "SLICE", size)
        assert index.read(whole).tolist() == words and "".join(dc.slices(whole)) == whole
    assert index.read("").tolist() == []


def test_planted_items(spark):
    rng, text, items = world(2)
    rows, planted = [(0, None), (1, "")], set()
    for d in range(2, 80):
        t = text(rng.randrange(1, 300))
        if d % 4 == 0:
            item = rng.randrange(45)
            words = items[item][1].split(" ")
            if d % 8 == 0:
                words[3] = "changed"
            t = t[: len(t) // 2] + " " + " ".join(words).upper() + " " + t[len(t) // 2 :]
            planted.add((d, item))
        rows.append((d, t))
    rows.append((90, " ".join(["filler"] * 60000) + " " + items[7][1]))
    planted.add((90, 7))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item", "'s' as score", "2 as id")
    benchmark = spark.createDataFrame([*items, (100, None), (101, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.decontaminate(docs, benchmark).collect()}
    assert got == planted
    assert dc.decontaminate(docs.limit(0), benchmark).count() == 0
    assert dc.decontaminate(docs, benchmark.limit(0)).count() == 0


def test_shards_change_nothing(spark, monkeypatch):
    rng, text, items = world(3)
    rows = []
    for k, (_, t) in enumerate(items * 4):
        words = dc.words_of(t)
        rows.append((k, " ".join([text(rng.randrange(40)), *words[: rng.randrange(len(words) // 2, len(words) + 1)], text(20)])))
    rows += [(None, "before " + items[0][1]), (500, items[5][1] + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (None, items[5][1] + " more")], "item_id long, text string")
    found = []
    for most in (20_000, 10):
        monkeypatch.setattr(dc, "SHARD_ITEMS", most)
        found.append(sorted(dc.decontaminate(docs, benchmark, overlap=0.3).collect(), key=str))
    assert found[0] == found[1] and len(found[0]) > 50
    assert {(None, 0)} <= {(r["doc_id"], r["item_id"]) for r in found[0]}
    assert None in {r["item_id"] for r in found[0]}
