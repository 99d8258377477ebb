"""Benchmark decontamination: BM25 over test items with block-max WAND, then overlap of question and answer.

The index is built from the test items: BM25 impacts by term, scaled so that an item scores 1 against its own text. Items lie in
blocks; a term's list holds the blocks that have it, each with the term's largest impact there. Training texts are read in
segments of ``segment`` words, at least as long as the longest item, and two segments in a row are one
passage, so any item that a text holds lies inside one passage.

Every passage is a query of its distinct terms, and a term a cursor over its blocks. Cursors are put in order; the first
block up to which the terms' largest impacts reach the threshold is the pivot: no earlier block can hold an item, and the
cursors before it skip to it. If the block's own maxima reach the threshold, its items are scored, else it is passed
unread. Many passages take these steps at once, as rows of one matrix. Every item at or above the threshold is retrieved and then
verified: shares of the item's question and answer n-grams that stand in the passage.

A benchmark larger than one index may be is searched in shards, each a pass over the texts. Document frequencies, mean length and the
longest item are those of the whole benchmark, so shards change no result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stash

THRESHOLD = 0.6
K1, B = 1.2, 0.75
BLOCK = 8
SEGMENT = 64
GRAM = 3
OVERLAP = 0.5
#: Items and bytes of text of one index; cells (term x block) of its skip lists, 8 bytes each. None changes a result
SHARD_ITEMS = 20_000
SHARD_BYTES = 16_000_000
TABLE_CELLS = 6_000_000
#: Words read at once; cells (passage x term) searched at once
CHUNK_WORDS = 100_000
CHUNK_CELLS = 400_000
#: Characters that are split into words at once
SLICE = 100_000
_WORD = re.compile(r"\w+")
_BLANK = re.compile(r"\s")
#: Bounds are sums of single-precision numbers
_SLACK = 1e-5


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def slices(text: str) -> Iterator[str]:
    """The text in parts that end at white space, so that no word is cut and case depends on nothing outside."""
    low = 0
    while low < len(text):
        end = _BLANK.search(text, min(low + SLICE, len(text)))
        high = end.end() if end else len(text)
        yield text[low:high]
        low = high


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Words of the question (up to the last question mark, or all sentences but the last) and of the answer (the rest); an item of one sentence is both."""
    text = (text or "").strip()
    if "?" in text[:-1]:
        k = text.rindex("?", 0, len(text) - 1) + 1
        parts = text[:k], text[k:]
    else:
        ends = [m.end() for m in re.finditer(r"[.!?]\s+", text)]
        parts = (text[: ends[-1]], text[ends[-1] :]) if ends else (text, text)
    question, answer = words_of(parts[0]), words_of(parts[1])
    return question or answer, answer or question


def grams(words: list, n: int = GRAM) -> set[tuple]:
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


class Statistics:
    """What BM25 needs of the whole benchmark: items, document frequencies, mean length, longest item."""

    def __init__(self, n: int, df: dict[str, int], mean: float, longest: int):
        self.n, self.df, self.mean, self.longest = n, df, mean, longest

    @staticmethod
    def of(texts: list[str]) -> Statistics:
        words = [w for w in map(words_of, texts) if w]
        lengths = [len(w) for w in words]
        return Statistics(len(words), Counter(x for w in words for x in set(w)), sum(lengths) / max(1, len(words)), max(lengths, default=1))


class Index:
    """Block-max index of items, scores scaled to each item's score against its own text."""

    def __init__(self, items: list[tuple[object, str]], statistics: Statistics | None = None, block: int = BLOCK):
        s = statistics or Statistics.of([t for _, t in items])
        read = [(i, words_of(t), question_and_answer(t)) for i, t in items]
        read = [x for x in read if x[1]]
        self.terms = {w: k for k, w in enumerate(sorted({w for _, words, _ in read for w in words}))}
        ids = lambda words: [self.terms[w] for w in words]
        #: (item id, term numbers of the item, of its question, of its answer)
        self.items = [(i, ids(words), ids(q), ids(a)) for i, words, (q, a) in read]
        self.segment = max(SEGMENT, s.longest)
        n, size = len(self.items), len(self.terms)
        self.block = max(block, -(-n * size // TABLE_CELLS))
        self.blocks = -(-n // self.block)
        rows, cols, impacts = [], [], []
        for k, (_, words, _) in enumerate(read):
            counts = Counter(words)
            length = K1 * (1 - B + B * len(words) / s.mean)
            own = {w: np.log(1 + (s.n - s.df[w] + 0.5) / (s.df[w] + 0.5)) * f * (K1 + 1) / (f + length) for w, f in counts.items()}
            total = sum(own.values())
            for w, x in own.items():
                rows.append(self.terms[w])
                cols.append(k)
                impacts.append(x / total)
        term, item, impact = np.array(rows, np.int64), np.array(cols, np.int64), np.array(impacts, np.float64)
        # postings by block: read only where a block is scored
        order = np.argsort(item // self.block, kind="stable") if n else np.empty(0, np.int64)
        self.block_start = np.searchsorted((item // self.block)[order], np.arange(self.blocks + 1))
        self.posting_term, self.posting_item, self.impact = term[order], item[order] % self.block, impact[order]
        # the last row stands for no term, the last block for the end of a list
        self.block_max = np.zeros((size + 1, self.blocks + 1), np.float32)
        np.maximum.at(self.block_max, (term, item // self.block), (impact * (1 + _SLACK)).astype(np.float32))
        self.greatest = self.block_max.max(axis=1)
        #: The first block from each block on that has the term
        at = np.where(self.block_max > 0, np.arange(self.blocks + 1), self.blocks).astype(np.int32)
        self.skip = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
        self._present = np.zeros(size + 1, bool)

    def candidates(self, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
        """(row, block) of the blocks whose maxima reach the threshold; terms: one passage a row, filled up with len(self.terms)."""
        row, frontier = np.arange(len(terms)), np.zeros(len(terms), np.int32)
        width = max(1, terms.shape[1])
        slots = np.arange(width, dtype=np.int32)
        most = self.greatest[terms]
        while len(row):
            # every cursor at its first block that is not passed, then cursors in order of their blocks
            ordered = self.skip[terms, frontier[:, None]] * np.int32(width) + slots
            ordered.sort(axis=1)
            reach = np.cumsum(np.take_along_axis(most, ordered % width, axis=1), axis=1) >= threshold - _SLACK
            pivot = ordered[np.arange(len(row)), reach.argmax(axis=1)] // width
            left = reach[:, -1] & (pivot < self.blocks)
            if not left.all():
                row, terms, most, pivot = row[left], terms[left], most[left], pivot[left]
            hit = self.block_max[terms, pivot[:, None]].sum(axis=1) >= threshold - _SLACK
            yield from zip(row[hit].tolist(), pivot[hit].tolist(), strict=True)
            frontier = pivot + 1

    def scores(self, terms: np.ndarray, block: int) -> np.ndarray:
        """Exact scores of a block's items for a set of terms."""
        a, b = self.block_start[block], self.block_start[block + 1]
        self._present[terms] = True
        self._present[-1] = False
        there = self._present[self.posting_term[a:b]]
        self._present[terms] = False
        return np.bincount(self.posting_item[a:b][there], self.impact[a:b][there], min(self.block, len(self.items) - block * self.block))

    def read(self, text: str) -> np.ndarray:
        """Term numbers of a text's words; len(self.terms) for words that no item has."""
        get, none = self.terms.get, len(self.terms)
        parts = [np.array([get(w, none) for w in _WORD.findall(part.lower())], np.int32) for part in slices(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.int32)


class Shard:
    """Items with the benchmark's statistics; each Python worker builds the index once."""

    def __init__(self, items: list[tuple[object, str]], statistics: Statistics):
        self.items, self.statistics = items, statistics

    @cached_property
    def index(self) -> Index:
        return Index(self.items, self.statistics)


def search(index: Index, texts: list[np.ndarray], threshold: float) -> Iterator[tuple[int, int, int, float]]:
    """(text, first segment of the passage, item, score) of all items at or above the threshold."""
    if not index.items:
        return
    none, segment = len(index.terms), index.segment
    lengths = np.array([len(t) for t in texts])
    pieces = np.maximum(1, -(-lengths // segment))
    base = np.concatenate([[0], np.cumsum(pieces)])
    term = np.concatenate(texts).astype(np.int64)
    piece = np.repeat(base[:-1], lengths) + (np.arange(len(term)) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // segment
    known = term < none
    piece, term = piece[known], term[known]
    # a segment's words belong to the passage that begins with it and to the one that ends with it; a text's last segment begins one only if it is alone
    text_of = np.repeat(np.arange(len(texts)), pieces)
    begins = np.ones(int(base[-1]), bool)
    begins[base[1:] - 1] = pieces == 1
    ends = np.arange(int(base[-1])) > base[text_of]
    own, before = begins[piece], ends[piece]
    key = np.sort(np.concatenate([piece[own] * none + term[own], (piece[before] - 1) * none + term[before]]))
    key = key[np.diff(key, prepend=-1) > 0]
    passage, term = key // none, key % none
    start = np.searchsorted(passage, np.arange(int(base[-1]) + 1))
    widths = np.diff(start)
    order = np.argsort(widths, kind="stable")
    order = order[widths[order] > 0]
    low = 0
    while low < len(order):
        # rows of nearly one width, as many as fit
        ascending = widths[order[low:]]
        high = low + max(1, int(np.searchsorted(ascending * np.arange(1, len(ascending) + 1), CHUNK_CELLS, "right")))
        rows = order[low:high]
        low = high
        matrix = np.full((len(rows), int(widths[rows].max())), none, np.int32)
        filled = np.arange(matrix.shape[1]) < widths[rows][:, None]
        matrix[filled] = term[np.concatenate([np.arange(start[r], start[r + 1]) for r in rows])]
        for row, block in index.candidates(matrix, threshold):
            scores = index.scores(matrix[row], block)
            for k in np.flatnonzero(scores >= threshold - 1e-9):
                p = int(rows[row])
                yield int(text_of[p]), p - int(base[text_of[p]]), block * index.block + int(k), float(scores[k])


def _overlap(part: list[int], there: set[tuple], words: list[int]) -> float:
    if len(part) < GRAM:
        n = len(part)
        return float(any(words[k : k + n] == part for k in range(len(words) - n + 1)))
    own = grams(part)
    return len(own & there) / len(own)


def matches(index: Index, texts: list[str], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple]:
    """(text, item id, score, question overlap, answer overlap, first word, end word) of verified items, the best passage of each text and item."""
    best: dict[tuple[int, int], tuple] = {}
    segment, held, numbers, total = index.segment, [], [], 0

    def settle() -> None:
        for text, p, item, score in search(index, held, threshold):
            at = held[text][p * segment : (p + 2) * segment].tolist()
            there = grams(at)
            _, own, question, answer = index.items[item]
            q, a = _overlap(question, there, at), _overlap(answer, there, at)
            if (q >= overlap and a >= overlap) or _overlap(own, there, at) >= 0.8:
                found = (round(score, 9), q, a, p * segment, p * segment + len(at))
                key = (numbers[text], item)
                if key not in best or found[:3] > best[key][:3]:
                    best[key] = found

    for k, text in enumerate(texts):
        held.append(index.read(text))
        numbers.append(k)
        total += len(held[-1])
        if total >= CHUNK_WORDS:
            settle()
            held, numbers, total = [], [], 0
    if held:
        settle()
    return [(k, index.items[item][0], *found) for (k, item), found in sorted(best.items())]


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words = [words_of(t) for t in batch["text"].tolist()]
        yield pd.DataFrame({"length": [len(w) for w in words], "words": [sorted(set(w)) for w in words]})


def shards(benchmark: DataFrame, item_col: str, item_text: str) -> list[Shard]:
    """The benchmark in shards of bounded size, each with the whole benchmark's statistics for its own words."""
    items = stash(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text")).where(F.trim("text") != "").distinct(), "items")
    read = items.select("text").mapInPandas(_lengths, "length long, words array<string>").where("length > 0")
    n, mean, longest = read.agg(F.count(F.lit(1)), F.avg("length"), F.max("length")).first()
    if not n:
        return []
    count, size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(-(-count // SHARD_ITEMS), -(-size // SHARD_BYTES))
    df = stash(read.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")), "frequencies") if parts > 1 else read.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    out = []
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        rows = sorted(((r["item"], r["text"]) for r in own.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))
        known = df
        if parts > 1:
            known = df.join(own.select("text").mapInPandas(_lengths, "length long, words array<string>").select(F.explode("words").alias("word")).distinct(), "word", "left_semi")
        out.append(Shard(rows, Statistics(n, {r["word"]: r["df"] for r in known.collect()}, mean, longest)))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """One row per row of docs and test item that it holds: id_col, item_id, score, question_overlap, answer_overlap, first_word, end_word (the passage).

    Null and empty texts and items match nothing; a null id of either side is carried like any other. Repeated rows, and several rows
    of one id, match each for itself; items that repeat id and text count once. A table without rows on either side
    gives none; other columns are ignored. Very long texts are read in slices; of equal passages of one text, the first is reported.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    schema = "id string, item_id string, score double, question_overlap double, answer_overlap double, first_word long, end_word long"
    out = None
    for shard in shards(benchmark, item_col, item_text):
        shared = spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value.index
            for batch in batches:
                ids = batch["id"].tolist()
                found = matches(index, batch["text"].tolist(), threshold, overlap)
                yield pd.DataFrame([(ids[m[0]], *m[1:]) for m in found], columns=["id", "item_id", "score", "question_overlap", "answer_overlap", "first_word", "end_word"])

        part = texts.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("item_id").cast(item_kind).alias("item_id"), "score", "question_overlap", "answer_overlap", "first_word", "end_word")
