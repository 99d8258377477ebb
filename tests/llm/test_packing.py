"""Packing: exact round trip of ids, fullness against the bound, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from diurna.llm import packing  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, World! it's don't I'LL", "İ. x", "a\x1cb", "é. É! ñandú", "<|endoftext|> x<|startoftext|>", "ǅ ﬁ ½ 12,3", "a b c", "ΑΣ. ΑΣ",
    "ß. ẞ.", "été", "ẛ̣", "word" * 500, "tab\tline\nfeed\r\n", "क़ יִ.", "x" * 100_000, "日本語 text", "\U0001f600!", "ªº.", "A.B,C",
]


def test_words_give_the_texts_ids():
    cached = packing.WordTokenizer(PATH, cache_words=30)
    rng = random.Random(1)
    more = ["".join(rng.choices("abcXYZÀßÿéí'.,!?;: \n ́٣3-", k=rng.randrange(60))) for _ in range(400)]
    for text in TEXTS + more:
        assert cached.ids(text) == cached._encode(text), repr(text)


def test_bins_are_as_full_as_an_exhaustive_search_finds():
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randrange(1, 41) for _ in range(rng.randrange(1, 10))]
        left = list(lengths)
        counts = {n: left.count(n) for n in left}
        for bin_ in packing.fill_bins(counts, 40):
            top = max(left)
            assert bin_[0] == top and sum(bin_) <= 40
            left.remove(top)
            best = max(sum(x for k, x in enumerate(left) if m >> k & 1) for m in range(1 << len(left)) if sum(x for k, x in enumerate(left) if m >> k & 1) <= 40 - top)
            assert sum(bin_) - top == best
            for n in bin_[1:]:
                left.remove(n)
        assert not left


def test_round_trip(spark):
    rng = random.Random(3)
    words = "the of alpha beta gamma delta mountain river, stone.".split()
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(0, 900)))) for k in range(300)] + [(1000, None), (1001, "x y z " * 30000), (None, "no id"), ((1 << 60) + 1, "large id"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as row", "3 as length")
    got = packing.pack(docs, PATH, keep_ids=True).toPandas()
    whole = packing.WordTokenizer(PATH)
    parts = {}
    for r in got.sort_values("start").itertuples():
        assert r.length == len(r.ids) // 4 <= 2048 and r.ids_crc32 == zlib.crc32(r.ids) and r.start == r.piece * 2048
        if not np.isnan(r.doc_id) and r.doc_id != 5:
            parts[int(r.doc_id)] = parts.get(int(r.doc_id), b"") + bytes(r.ids)
    assert parts == {d if d < 1 << 53 else int(float(d)): whole._encode(t or "") + b"\0\0\0\0" for d, t in rows if d is not None and d != 5}
    assert {r[0] for r in packing.pack(docs, PATH).select("doc_id").collect()} == {r[0] for r in rows}
    total = 0
    for _, bin_ in got.sort_values("offset").groupby("sequence_id"):
        assert (bin_["offset"].to_numpy() == np.concatenate([[0], np.cumsum(bin_["length"].to_numpy())[:-1]])).all() and bin_["length"].sum() <= 2048
        total += 1
    assert total <= -(-got["length"].sum() // 2048) + 1
    assert packing.pack(docs.limit(0), PATH).count() == 0
