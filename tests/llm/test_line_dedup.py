"""Line dedup against a plain version over all chunks at once, and the boundaries' shift resistance."""

import itertools
import random

import xxhash

from diurna.llm import line_dedup as line_dedup_module
from diurna.llm.line_dedup import LONG_LINE, chunks, line_dedup


def runs_of(text):
    """(first, end) of all runs of lines that are compared, from the rules: content-defined chunks, and runs of just enough words."""
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    digests = [xxhash.xxh64_intdigest(x.encode()) for x in lines]
    found, first = set(), 0
    for k in range(len(lines)):
        if words[k] >= LONG_LINE:
            found |= {(first, k), (k, k + 1)}
            first = k + 1
        elif k + 1 - first >= 64 or k > first and (((digests[k - 1] * 0x9E3779B97F4A7C15 + digests[k]) % 2**64) >> 20) % 3 == 0:
            found.add((first, k + 1))
            first = k + 1
    found.add((first, len(lines)))
    found = {(a, b) for a, b in found if b - a >= 2 or b > a and words[a] >= LONG_LINE}
    sums = [0, *itertools.accumulate(words)]
    for a in range(len(lines)):
        for b in range(a + 1, len(lines) + 1):
            if sums[b] - sums[a] >= LONG_LINE and (sums[b - 1] - sums[a] < LONG_LINE or sums[b] - sums[a + 1] < LONG_LINE):
                found.add((a, b))
    return found


def brute(rows):
    """Expected texts for distinct ids, by comparing the text of all runs."""
    places = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        for a, b in runs_of(text or ""):
            places.setdefault("\n".join(lines[a:b]), []).append((doc, a, b))
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for found in places.values():
            keep = min(found)
            for d, a, b in found:
                if d == doc and (d, a, b) != keep:
                    gone.update(range(a, b))
        out[doc] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_rolling_hash_of_more_lines(monkeypatch):
    """With a longer window the hash is that of the window's lines, wherever the chunk began."""
    monkeypatch.setattr(line_dedup_module, "ROLL", 4)
    monkeypatch.setattr(line_dedup_module, "_TOP", pow(0x9E3779B97F4A7C15, 3, 2**64))
    monkeypatch.setattr(line_dedup_module, "LEAST_LINES", 5)
    rng = random.Random(21)
    lines = [f"line {rng.random()}" for _ in range(300)]
    digests = [xxhash.xxh64_intdigest(x.encode()) for x in lines]
    for a, b in chunks("\n".join(lines))[:-1]:
        value = 0
        for d in digests[b - 4 : b]:
            value = (value * 0x9E3779B97F4A7C15 + d) % 2**64
        assert b - a == 64 or (value >> 20) % 3 == 0


def test_chunks_cover_all_lines_and_come_back_in_step():
    rng = random.Random(1)
    lines = [f"line {rng.random()}" for _ in range(200)]
    text = "\n".join(lines)
    spans = chunks(text)
    assert [x for a, b in spans for x in range(a, b)] == list(range(200))
    moved = "\n".join(["one", "two", "three", *lines])
    same = {"\n".join(lines[a:b]) for a, b in spans} & {"\n".join((["one", "two", "three"] + lines)[a:b]) for a, b in chunks(moved)}
    assert len(same) > 0.9 * len(spans)
    long = " ".join(["w"] * LONG_LINE)
    assert (1, 2) in chunks(f"a\n{long}\nb")


def test_against_brute_force(spark):
    rng = random.Random(3)
    pool = [f"sentence number {k} of the pool." for k in range(60)]
    passage = " ".join(f"word{k}" for k in range(70))
    rows = [(1, None), (2, ""), (3, "one line"), (4, "one line"), (5, passage + "\nx"), (6, "y\n" + passage), (7, "\n".join(["same", "lines"] * 40)), (8, "z " * 90000 + "\n" + passage)]
    for doc in range(10, 60):
        k = rng.randrange(40)
        rows.append((doc, "\n".join(pool[k : k + 15] + [f"own {doc}"] + rng.sample(pool, 3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'h' as hash", "1 as id", "2 as times")
    got = {r["doc_id"]: r["text"] for r in line_dedup(docs).collect()}
    assert got == brute(rows)
    assert got[5].startswith("word0") and got[6] == "y"


def test_repeated_rows_nulls_and_empty_table(spark):
    text = "\n".join(f"line {k}" for k in range(12))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup(docs).collect())
    assert got[0] == (0, text) and got[1] == got[2] == (1, text) and got[3][1] != text
    assert line_dedup(docs.limit(0)).count() == 0


def test_wrapped_passages_go_whole(spark):
    rng = random.Random(9)
    rows, passages = [], {}
    for k in range(120):
        sizes = rng.choice([[20, 20, 20], [17] * 3, [20, 20, 20, 5], [3, 0, 48], [49, 0, 1], [10] * 8, [1] * 50, [30, 30]])
        passage = "\n".join(" ".join(f"p{k}l{j}w{i}" for i in range(n)) for j, n in enumerate(sizes))
        passages[k] = passage
        for half in (0, 1):
            own = [f"own {k} {half} {j}" for j in range(rng.randrange(1, 9))]
            rows.append((2 * k + half, "\n".join([*own, passage, f"end {k} {half}"])))
    got = {r["doc_id"]: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        assert got[doc]["text"] == (text.replace(passages[doc // 2] + "\n", "") if doc % 2 else text)
        assert got[doc]["lines_removed"] == (passages[doc // 2].count("\n") + 1 if doc % 2 else 0)
