"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are a text's words and their beginnings, a beginning that is used often being further terms. A term's weight is its TF-IDF times its
squared association with the label (chi-squared over the number of examples, less what chance gives on average): the supervised weighting
tf.idf.chi2 with the usual correction of its bias. No term is chosen: all that two labelled examples have are weighed alike, and those
that the label depends on by no more than chance have the weight 0.

A term's list holds its examples in the order of their weights, in blocks of ``BLOCK``, the first of which is the block's largest. A query reads the
blocks of all its terms in the order of what they can add to a cosine. What each list could still add bounds the cosines of all examples; blocks
are read until few examples can be one of the ``NEIGHBOURS`` nearest, and their cosines are then worked out in full. The other blocks (of
common words, which weigh little and have the longest lists) are never read. All ties of the last neighbour count. Neighbours vote with the square of their cosine, and
the toxic share of the votes becomes a probability by isotonic regression over examples that were scored by an index without them. The nearest
example is the evidence.

Fitting uses at most ``TOXIC_SAMPLE`` and ``CLEAN_SAMPLE`` labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_training_row, small_batches, stash

#: Most labelled rows of each kind that fitting uses; documented bounds
TOXIC_SAMPLE = 500
CLEAN_SAMPLE = 1000
#: Beginnings of words that are terms, besides the words themselves
BEGINNINGS = (3, 5)
#: A beginning that a text has more than once, and at least once in so many words, is a further term for each number it meets: chance hits of long texts and repeated use differ
LEVELS = (256, 128, 64, 32, 16)
NEIGHBOURS = 10
BLOCK = 32
#: Blocks that are read first; each further step reads as many again as were read so far
STEP = 256
#: Cosines are worked out in full once so few examples are left
FEW = 96
#: Parts of the examples, each of which is scored by an index of the others
FOLDS = 4
_WORD = re.compile(r"\w+")
_CACHE = 200_000
_SLACK = 1e-6


def word_terms(word: str) -> list[str]:
    """The word, marked by a final blank, and its beginnings."""
    n = len(word)
    return [word + " ", *[word[:k] for k in BEGINNINGS if k <= n]]


def number(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


def words_of(text: str | None) -> Counter:
    return Counter(_WORD.findall((text or "").lower()))


def text_terms(text: str | None) -> dict[str, int]:
    """All terms of a text, levels included, with their counts (1 for a level)."""
    counts: dict[str, int] = {}
    words = words_of(text)
    total = words.total()
    for word, n in words.items():
        for t in word_terms(word):
            counts[t] = counts.get(t, 0) + n
    levels = {f"{t} x{level}": 1 for t, n in counts.items() if n > 1 and t[-1] != " " for level in LEVELS if n * level >= total}
    return counts | levels


class Reader:
    """Places in a vocabulary of the terms of texts."""

    def __init__(self, vocabulary: list[str]):
        split = [t.rpartition(" x") for t in vocabulary]
        leveled = [(base, int(level)) if base and level.isdigit() else (t, 0) for t, (base, _, level) in zip(vocabulary, split, strict=True)]
        #: Words and beginnings that have a place themselves or by a level, numbered
        self.bases = {t: k for k, t in enumerate(dict.fromkeys(t for t, _ in leveled))}
        self.place = np.full(len(self.bases), -1)
        self.level_place = np.full((len(LEVELS), len(self.bases)), -1)
        for k, (base, level) in enumerate(leveled):
            if level:
                self.level_place[LEVELS.index(level), self.bases[base]] = k
            else:
                self.place[self.bases[base]] = k
        self.levels = np.array(LEVELS)[:, None]
        self.known: dict[str, tuple[int, ...]] = {}

    def _terms(self, word: str) -> tuple[int, ...]:
        if len(self.known) >= _CACHE:
            self.known.clear()
        found = tuple(self.bases[t] for t in word_terms(word) if t in self.bases)
        if len(word) <= 64:
            self.known[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(terms, counts) of a whole text, in no order."""
        get, new, counts = self.known.get, self._terms, {}
        words = words_of(text)
        for word, n in words.items():
            found = get(word)
            if found is None:
                found = new(word)
            for t in found:
                counts[t] = counts.get(t, 0) + n
        bases, times = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))
        own = self.place[bases]
        more = times > 1
        by_level = self.level_place[:, bases[more]]
        met = by_level[(by_level >= 0) & (times[more] * self.levels >= words.total())]
        return np.concatenate([own[own >= 0], met]), np.concatenate([times[own >= 0], np.ones(len(met), np.int64)])


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end."""
    n = end - start
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class Index:
    """Labelled examples: vectors by blocks, bounds by terms. examples: (id, (terms, counts), toxic), terms as 64-bit numbers."""

    def __init__(self, examples: list[tuple[str, tuple[np.ndarray, np.ndarray], bool]], toxic_weight: float = 1.0, clean_weight: float = 1.0):
        examples = sorted(examples, key=lambda e: e[0])
        toxic = np.array([e[2] for e in examples], bool)
        lengths = np.array([len(e[1][0]) for e in examples], np.int64)
        hashes = np.concatenate([e[1][0] for e in examples]) if examples else np.empty(0, np.uint64)
        counts = np.concatenate([e[1][1] for e in examples]) if examples else np.empty(0, np.int64)
        row = np.repeat(np.arange(len(examples)), lengths)
        self.vocabulary, term, df = np.unique(hashes, return_inverse=True, return_counts=True) if len(hashes) else (hashes, np.empty(0, np.int64), np.empty(0, np.int64))
        # a term of one example links no two
        shared = df > 1
        place = np.cumsum(shared) - 1
        keep = shared[term]
        self.vocabulary, term, counts, row = self.vocabulary[shared], place[term[keep]], counts[keep], row[keep]
        #: The terms themselves, where somebody has asked for them: see name_terms()
        self.names: list[str] = []
        v, n, a_all = len(self.vocabulary), float(len(examples)), float(toxic.sum())
        with_term = df[shared].astype(np.float64)
        a = np.bincount(term, toxic[row], v)
        cross = a * (n - a_all) - (with_term - a) * a_all
        even = with_term * (n - with_term) * a_all * (n - a_all)
        # chi-squared / n, less what it is by chance
        association = np.maximum(0.0, np.divide(cross * cross, even, out=np.zeros(v), where=even > 0) - 1 / max(1.0, n - 1))
        #: Weight of a term that a text has once
        self.weight = (np.log((n + 1) / (with_term + 1)) + 1) * association
        # terms that the label doesn't depend on by as much as chance gives add nothing to any cosine
        told = self.weight > 0
        place = np.cumsum(told) - 1
        keep = told[term]
        self.vocabulary, self.weight, term, counts, row = self.vocabulary[told], self.weight[told], place[term[keep]], counts[keep], row[keep]
        v = len(self.vocabulary)
        value = (1 + np.log(counts)) * self.weight[term]
        norm = np.sqrt(np.bincount(row, value * value, len(examples)))
        value = value / np.where(norm > 0, norm, 1)[row]
        self.ids = [e[0] for e in examples]
        # every example has one vote; that the kinds were sampled unlike is made up for by the calibration
        self.votes = np.where(toxic[:, None], [[1.0, 0.0]], [[0.0, 1.0]])
        stands_for = np.array([toxic_weight, clean_weight])
        self.there = norm > 0
        # lists of terms, the largest weights first
        by_term = np.lexsort((row, -value, term))
        self.item, self.impact = row[by_term], value[by_term]
        self.start = np.searchsorted(term[by_term], np.arange(v + 1))
        # vectors of examples
        by_row = np.argsort(row, kind="stable")
        self.term, self.value = term[by_row], value[by_row]
        self.vector = np.searchsorted(row[by_row], np.arange(len(examples) + 1))
        bare = self.votes[~self.there].sum(axis=0) * stands_for
        every = self.votes.sum(axis=0) * stands_for
        #: Toxic rate of all examples, and of those that a text without any term is like
        self.rate = float(every[0] / every.sum()) if examples else 0.0
        self.base = float((bare[0] + self.rate) / (bare.sum() + 1))
        self.calibration: tuple[np.ndarray, np.ndarray] | None = None
        self._query = np.zeros(v, np.float64)

    def __getstate__(self) -> dict:
        return {k: x for k, x in self.__dict__.items() if k != "_query"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._query = np.zeros(len(self.vocabulary), np.float64)

    def nearest(self, terms: np.ndarray, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example, cosine) of so many nearest examples, and all ties of the last one."""
        weight = (1 + np.log(counts)) * self.weight[terms]
        terms, weight = terms[weight > 0], weight[weight > 0]
        if not len(terms) or not self.ids:
            return np.empty(0, np.int64), np.empty(0)
        weight = weight / np.sqrt((weight * weight).sum())
        start, end = self.start[terms], self.start[terms + 1]
        blocks = -(-(end - start) // BLOCK)
        last = np.cumsum(blocks) - 1
        of = np.repeat(np.arange(len(terms)), blocks)
        first = start[of] + (np.arange(len(of)) - np.repeat(last + 1 - blocks, blocks)) * BLOCK
        adds = weight[of] * self.impact[first]
        after = np.append(adds[1:], 0.0)
        after[last] = 0.0
        order = np.argsort(-adds, kind="stable")
        # what all lists together could still add after so many blocks
        left = np.concatenate([[adds[last + 1 - blocks].sum()], np.cumsum(after[order] - adds[order]) + adds[last + 1 - blocks].sum()]) + _SLACK
        partial, low, high = np.zeros(len(self.ids)), 0, min(STEP, len(order))
        while True:
            read = order[low:high]
            till = np.minimum(first[read] + BLOCK, end[of[read]])
            postings = _ranges(first[read], till)
            partial += np.bincount(self.item[postings], self.impact[postings] * np.repeat(weight[of[read]], till - first[read]), len(partial))
            top = np.argpartition(-partial, neighbours)[:neighbours] if len(partial) > neighbours else np.arange(len(partial))
            least = self._least(partial[top], neighbours) - _SLACK
            alive = np.flatnonzero(partial + left[high] >= max(least, 2 * _SLACK))
            if len(alive) <= FEW or high == len(order):
                break
            low, high = high, min(2 * high, len(order))
        self._query[terms] = weight
        begin, end = self.vector[alive], self.vector[alive + 1]
        entries = _ranges(begin, end)
        cosines = np.bincount(np.repeat(np.arange(len(alive)), end - begin), self.value[entries] * self._query[self.term[entries]], len(alive))
        self._query[terms] = 0
        least = max(self._least(cosines, neighbours) - _SLACK, _SLACK)
        found, cosines = alive[cosines >= least], cosines[cosines >= least]
        order = np.lexsort((found, -np.round(cosines, 6)))
        return found[order], cosines[order]

    def _least(self, cosines: np.ndarray, neighbours: int) -> float:
        return float(np.partition(cosines, -neighbours)[-neighbours]) if len(cosines) >= neighbours else 0.0

    def share(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float | None, int | None, float]:
        """(toxic share of the votes, nearest example, its cosine); no share without a neighbour."""
        found, cosines = self.nearest(terms, counts)
        if not len(found):
            return None, None, 0.0
        votes = ((cosines / cosines[0]) ** 2)[:, None] * self.votes[found]
        toxic, clean = votes.sum(axis=0)
        return float(toxic / (toxic + clean)), int(found[0]), float(min(1.0, cosines[0]))

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, str | None, float]:
        """(score, id of the nearest example, its cosine)"""
        share, nearest, cosine = self.share(terms, counts)
        if share is None:
            return self.base, None, 0.0
        if self.calibration is not None:
            share = float(np.interp(share, *self.calibration))
        return share, self.ids[nearest], cosine


def isotonic(shares: np.ndarray, toxic: np.ndarray, weights: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(shares, probabilities): the non-decreasing step function next to the labels, each step's rate with one example of the overall rate added; to be interpolated."""
    order = np.argsort(shares, kind="stable")
    steps: list[list[float]] = []  # weight, toxic weight, weighted sum of shares
    for k in order.tolist():
        steps.append([weights[k], weights[k] * toxic[k], weights[k] * shares[k]])
        while len(steps) > 1 and (steps[-2][1] * steps[-1][0] >= steps[-1][1] * steps[-2][0] or steps[-1][2] * steps[-2][0] == steps[-2][2] * steps[-1][0]):
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last, strict=True)]
    x = np.array([s[2] / s[0] for s in steps])
    p = np.array([(s[1] + rate) / (s[0] + 1) for s in steps])
    return x, np.maximum.accumulate(p)


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, toxic_sample: int, clean_sample: int) -> tuple[DataFrame, int, int]:
    """(id, text, toxic) of the sample, one row per id, and the numbers of labelled training rows of both kinds."""
    marked = (
        labels.where(is_training_row(F.col(id_col)) & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
        .join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    )
    counts = dict(marked.groupBy("toxic").count().collect())
    take = lambda kind, n: marked.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(n)
    ids = take(1, toxic_sample).unionByName(take(0, clean_sample))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # of the rows that share an id the one with the least text, so that no more rows come than were asked for
    sample = texts.join(F.broadcast(ids), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    return sample, counts.get(1, 0), counts.get(0, 0)


def numbered(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(terms as 64-bit numbers, counts) of a text."""
    found = text_terms(text)
    return np.array([number(t) for t in found], np.uint64), np.array(list(found.values()), np.int64)


def examples_of(sample: DataFrame) -> list[tuple[str, tuple[np.ndarray, np.ndarray], bool]]:
    @F.pandas_udf("struct<terms:binary,counts:binary>")
    def read(texts: pd.Series) -> pd.DataFrame:
        found = [numbered(t) for t in texts]
        return pd.DataFrame({"terms": [t.tobytes() for t, _ in found], "counts": [c.astype("<u4").tobytes() for _, c in found]})

    rows = sample.select(F.col("id").cast("string").alias("id"), "toxic", read("text").alias("v")).collect()
    return [(r["id"], (np.frombuffer(r["v"]["terms"], np.uint64), np.frombuffer(r["v"]["counts"], "<u4").astype(np.int64)), r["toxic"] == 1) for r in rows]


def name_terms(sample: DataFrame, index: Index) -> None:
    """Give the index its terms as text: the sample is read once more, and each term that is in the vocabulary comes once."""
    shared = sample.sparkSession.sparkContext.broadcast(index.vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = {h: k for k, h in enumerate(shared.value.tolist())}
        seen: set[str] = set()
        for batch in batches:
            for text in batch["text"].tolist():
                seen.update(text_terms(text))
        found = [(places[h], t) for t in seen if (h := number(t)) in places]
        yield pd.DataFrame(found, columns=["place", "term"])

    names = dict(sample.select("text").mapInPandas(run, "place long, term string").groupBy("place").agg(F.min("term").alias("term")).collect())
    index.names = [names[k] for k in range(len(index.vocabulary))]


def calibrate(index: Index, examples: list, toxic_weight: float, clean_weight: float, folds: int = FOLDS) -> None:
    """Give the index a calibration: each part of the examples is scored by an index of the others, weights included."""
    shares, toxic = [], []
    for fold in range(folds):
        apart = [e for e in examples if xxhash.xxh32_intdigest(e[0]) % folds == fold]
        rest = [e for e in examples if xxhash.xxh32_intdigest(e[0]) % folds != fold]
        if not apart or len({e[2] for e in rest}) < 2:
            continue
        own = Index(rest, toxic_weight, clean_weight)
        for _, (hashes, counts), label in apart:
            at = np.searchsorted(own.vocabulary, hashes)
            known = np.zeros(len(hashes), bool)
            inside = at < len(own.vocabulary)
            known[inside] = own.vocabulary[at[inside]] == hashes[inside]
            share, _, _ = own.share(at[known], counts[known])
            if share is not None:
                shares.append(share)
                toxic.append(label)
    if len(set(toxic)) == 2:
        toxic = np.array(toxic, np.float64)
        index.calibration = isotonic(np.array(shares), toxic, np.where(toxic > 0, toxic_weight, clean_weight), index.rate)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic_sample: int = TOXIC_SAMPLE, clean_sample: int = CLEAN_SAMPLE) -> Index:
    sample, toxic, clean = labelled(docs, labels, id_col, text_col, label_col, toxic_sample, clean_sample)
    sample = stash(sample, "labelled")
    examples = examples_of(sample)
    # what an example of each kind stands for, relative to the kind that was sampled less thinly
    per_toxic, per_clean = max(1.0, toxic / max(1, toxic_sample)), max(1.0, clean / max(1, clean_sample))
    least = min(per_toxic, per_clean)
    index = Index(examples, per_toxic / least, per_clean / least)
    calibrate(index, examples, per_toxic / least, per_clean / least)
    name_terms(sample, index)
    return index


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted, nearest_id and nearest_cosine (the evidence; null and 0 where no example shares a term).

    Labels are read only from training rows (crc32 of the id modulo 3 is not 1). Null and empty texts get the rate of
    examples without any term. Repeated rows are scored each for itself; of an id labelled twice the larger label holds, and of an id with
    several texts the least one is its example. Without labels of both kinds every text gets the same score. Very long texts are
    read whole. Other columns are ignored; a table without rows gives none.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        reader = Reader(index.names)
        # copies of a text come up again and again
        known: dict[bytes, tuple] = {}

        def score(text: str | None) -> tuple:
            key = xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))
            if key not in known:
                if len(known) >= _CACHE // 4:
                    known.clear()
                known[key] = index.score(*reader(text))
            return known[key]

        for batch in batches:
            rows = [score(text) for text in batch["text"].tolist()]
            out = pd.DataFrame(rows, columns=["score", "nearest_id", "nearest_cosine"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    scored = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id string, score double, nearest_id string, nearest_cosine double")
    return scored.select(
        F.col("id").cast(kind).alias(id_col),
        F.coalesce(~is_training_row(F.col("id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.col("nearest_id").cast(kind).alias("nearest_id"),
        "nearest_cosine",
    )
