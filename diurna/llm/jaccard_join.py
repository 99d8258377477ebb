"""Near duplicates: Jaccard join of word 5-shingle sets by chosen paths.

Texts with the same words form one class; one representative of each goes on. A representative's set is embedded in
``COORDINATES`` min-hash tokens (a hash function each; the share of equal tokens estimates the Jaccard similarity,
with the same error for sets of any size).
Chosen path: a run samples one coordinate and splits all texts by their tokens there; a node of over ``SMALL`` members samples
coordinates of its own, 1 / (similarity x coordinates) each, and splits again, to whatever depth it takes. Small nodes, and nodes that
a split leaves nearly whole, are searched by brute force over the tokens, which gives linked sets (never all pairs of one).
Runs are repeated until a pair at the bound is missed by all of them with a probability of ``MISSED`` at most: repeats() gives
their number by the depth of the recursion, and members of deep nodes get as many more runs as their depth asks for.

Inside a linked set every pair is then compared exactly, by its shingles, in blocks: links are counted, not listed. A linked set of over
``WHOLE`` members (a large group of near copies) is not compared as a whole but inside the nodes that its members share, each pair in the first one,
so that a member's shingles travel to as many places as it has nodes, not to as many as the group has blocks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, small_batches, stash

WORDS = 5
SIMILARITY = 0.8
COORDINATES = 128
SMALL = 2048
#: Most levels of the recursion; with every level a node loses members, so it ends by itself long before
DEPTH = 40
#: A node that keeps this share of its parent holds near copies of each other, which no token splits: it is searched as it is
DENSE = 0.7
#: Probability that all runs miss a pair at the bound, and that the estimate drops it before the exact comparison
MISSED = 1e-6
#: Members of one block in the exact comparison; of one task's node in the brute force
BLOCK = 1024
NODE_BLOCK = 8192
#: Members of a linked set that is compared as a whole
WHOLE = 8192
_WORD = re.compile(r"\w+")
_CACHE_WORDS = 200_000


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, words: int = WORDS):
        self.words, self.cache = words, {}

    def _hash(self, word: str) -> int:
        if len(self.cache) >= _CACHE_WORDS:
            self.cache.clear()
        return self.cache.setdefault(word, xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")))

    def __call__(self, text: str | None) -> tuple[str, np.ndarray]:
        """(class key of the words, hashes). A text of fewer words than a shingle has one shingle of all; one without words none."""
        words = _WORD.findall((text or "").lower())
        if not words:
            return "", np.empty(0, np.uint64)
        get, new = self.cache.get, self._hash
        one = np.array([get(w) or new(w) for w in words], dtype=np.uint64)
        n = max(1, len(one) - self.words + 1)
        mixed = np.zeros(n, np.uint64)
        for k in range(min(self.words, len(one))):
            mixed = (mixed ^ one[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return xxhash.xxh3_128_hexdigest(" ".join(words).encode("utf-8", "surrogatepass")), np.unique(mixed)


def _odd_and_shift(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiplier and summand of each coordinate's hash function: fixed values."""
    drawn = np.array([xxhash.xxh64_intdigest(f"coordinate {k}") for k in range(2 * coordinates)], np.uint64).reshape(2, coordinates, 1)
    return drawn[0] | np.uint64(1), drawn[1]


_ODD, _SHIFT = _odd_and_shift(COORDINATES)


def tokens(hashes: np.ndarray) -> np.ndarray:
    """64-bit min-hash tokens, each by a hash function of its own, so that they stay independent in small sets as well."""
    value = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), 512):
        mixed = _ODD * hashes[low : low + 512]
        mixed += _SHIFT
        np.minimum(value, mixed.min(axis=1), out=value)
    value ^= value >> np.uint64(31)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def least_equal(similarity: float = SIMILARITY, coordinates: int = COORDINATES, missed: float = MISSED) -> int:
    """The largest bound on equal tokens that a pair at the similarity stays under with at most this probability (binomial)."""
    below = 0.0
    for k in range(coordinates + 1):
        below += math.comb(coordinates, k) * similarity**k * (1 - similarity) ** (coordinates - k)
        if below > missed:
            return k
    return coordinates


def repeats(depth: int, similarity: float = SIMILARITY, missed: float = MISSED) -> int:
    """Runs after which a pair at the similarity has shared no node at this depth with at most this probability.

    The pair's tokens agree in the run's coordinate with the similarity as probability. A split keeps the pair together if any of its
    coordinates agrees: their number is nearly Poisson with mean 1 / similarity, and 1 where that gives none.
    """
    mean = 1 / similarity
    split = similarity * math.exp(-mean) + 1 - math.exp(-mean) - math.exp(-mean) * (math.exp(mean * (1 - similarity)) - 1)
    return min(COORDINATES, math.ceil(math.log(missed) / math.log(1 - similarity * split ** (depth - 1))))


#: Coordinates in the order in which runs sample them
ORDER = [(r * 53) % COORDINATES for r in range(COORDINATES)]
#: Runs over all texts
RUNS = repeats(1)
FIRST = ORDER[:RUNS]


def _sketch(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            keys, sketches, roots = [], [], []
            for text in batch["text"].tolist():
                key, hashes = shingler(text)
                keys.append(key)
                value = tokens(hashes) if len(hashes) else None
                # 16 bits of a token are enough to estimate a similarity and to split a node; the first level splits all texts at once and takes 64
                sketches.append(None if value is None else (value >> np.uint64(48)).astype("<u2").tobytes())
                roots.append(None if value is None else value[FIRST].tobytes())
            yield pd.DataFrame({"id": batch["id"], "words": keys, "sketch": pd.Series(sketches, dtype=object), "roots": pd.Series(roots, dtype=object)})

    return run


def linked(sketches: np.ndarray, least: int) -> np.ndarray:
    """Component of each row, where rows with at least so many equal tokens are linked. Rows that are in one component already aren't compared."""
    n = len(sketches)
    root = np.arange(n)
    todo = np.arange(n)
    while len(todo) > 1:
        pivot, todo = todo[0], todo[1:]
        near = todo[(sketches[todo] == sketches[pivot]).sum(axis=1) >= least]
        if len(near):
            root[near] = pivot
            todo = np.setdiff1d(todo, near, assume_unique=True)
    # stars around pivots are now disjoint; two stars are one component if any member of one is linked with any of the other
    pivots, counts = np.unique(root, return_counts=True)
    if len(pivots) == 1 or counts.max() == 1:
        return root
    component = root.copy()
    # a pivot was compared with all that no star had yet, so a link between two stars has an end that is no pivot
    for k in np.flatnonzero(root != np.arange(n)):
        others = np.flatnonzero(component != component[k])
        near = others[(sketches[others] == sketches[k]).sum(axis=1) >= least]
        for other in np.unique(component[near]):
            low, high = sorted((component[k], other))
            component[component == high] = low
    return component


def _brute(least: int):
    """Over rows sorted by node: (key, root) of members linked within their node."""

    def edges(block: pd.DataFrame) -> pd.DataFrame | None:
        if len(block) < 2:
            return None
        block = block.sort_values("key")
        keys = block["key"].to_numpy(np.int64)
        sketches = np.frombuffer(b"".join(block["sketch"]), "<u2").reshape(len(keys), -1)
        root = linked(sketches, least)
        moved = root != np.arange(len(keys))
        return pd.DataFrame({"a": keys[moved], "b": keys[root[moved]]}) if moved.any() else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            node = batch[["node", "part"]].to_numpy()
            cut = np.flatnonzero((node[1:] != node[:-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], cut])
            ends = np.concatenate([cut, [len(batch)]])
            out = []
            for a, b in zip(starts, ends, strict=True):
                if rest and (rest[0][["node", "part"]].iloc[0].to_numpy() != node[a]).any():
                    out.append(edges(pd.concat(rest)))
                    rest = []
                if b < len(batch):
                    if rest:
                        out.append(edges(pd.concat([*rest, batch.iloc[a:b]])))
                        rest = []
                    elif b - a > 1:
                        out.append(edges(batch.iloc[a:b]))
                else:
                    rest.append(batch.iloc[a:b])
            out = [x for x in out if x is not None]
            if out:
                yield pd.concat(out)
        if rest and (last := edges(pd.concat(rest))) is not None:
            yield last

    return run


def connected(edges: DataFrame, what: str = "edges") -> DataFrame:
    """(key, root) of every key in edges(a, b): the least key of its component, by alternating large and small stars."""
    edges = stash(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), what)
    before = None
    while True:
        # large star: neighbours above a key move to the least key around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.distinct()
        # small star: neighbours below a key, and itself, move to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        last, edges = edges, stash(small.where("a <> b").distinct(), what)
        release(last)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())


def _paths(members: DataFrame, first: str, reps: DataFrame, small: int, similarity: float) -> tuple[DataFrame, int, DataFrame | None]:
    """(node, key) of the nodes to be searched, the depth reached, and the keys of nodes that were split; first: the array of members' nodes at the first level."""
    level = members.select("key", F.explode(F.expr(first)).alias("node"), F.lit(None).cast("long").alias("parent"))
    out = deep = None
    for d in range(1, DEPTH + 1):
        sized = level.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("parent").alias("of")).where("n > 1")
        level = stash(level.select("node", "key").join(sized, "node"), f"paths-{d}")
        ends = (F.col("n") <= small) | F.coalesce(F.col("n") >= DENSE * F.col("of"), F.lit(False)) | F.lit(d == DEPTH)
        done = level.where(ends).select("node", "key")
        out = done if out is None else out.unionByName(done)
        split = level.where(~ends)
        if d == DEPTH or split.isEmpty():
            return out, d, deep
        deep = split.select("key").distinct() if deep is None else deep
        share = int(1_000_000 / (similarity * COORDINATES))
        sampled = f"filter(sequence(0, {COORDINATES - 1}), i -> pmod(xxhash64(node, i), 1000000) < {share})"
        # a node that samples none takes one
        chosen = f"if(size({sampled}) > 0, {sampled}, array(cast(pmod(xxhash64(node), {COORDINATES}) as int)))"
        level = (
            split.select("node", "key", "n")
            .join(reps.select("key", "sketch"), "key")
            .select("key", "sketch", "node", "n", F.explode(F.expr(chosen)).alias("i"))
            .select("key", F.expr("xxhash64(node, i, substring(sketch, 2 * i + 1, 2))").alias("node"), F.col("n").alias("parent"))
        )
    return out, DEPTH, deep


def leaves(reps: DataFrame, small: int = SMALL, similarity: float = SIMILARITY) -> DataFrame:
    """(node, key): the nodes of all runs that are searched by brute force, of two members or more."""
    first = "array(" + ", ".join(f"xxhash64({r}, substring(roots, {8 * r + 1}, 8))" for r in range(RUNS)) + ")"
    out, depth, deep = _paths(reps, first, reps, small, similarity)
    done = RUNS
    while deep is not None and (needed := repeats(depth, similarity)) > done:
        # whoever was in a node that was split takes more runs
        more = "array(" + ", ".join(f"xxhash64({r}, substring(sketch, {2 * ORDER[r] + 1}, 2))" for r in range(done, needed)) + ")"
        found, reached, deep = _paths(reps.join(deep, "key", "left_semi"), more, reps, small, similarity)
        out, depth, done = out.unionByName(found), max(depth, reached), needed
    return out


def _blocks(frame: DataFrame, group: str, size: int) -> DataFrame:
    """frame with column part: each pair of a large group's blocks is one part, so that any two members share one."""
    counts = frame.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    return (
        frame.join(counts, group)
        .withColumn("_blocks", F.ceil(F.col("_n") / size).cast("int"))
        .withColumn("_own", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("part", F.least("_own", "_with") * F.col("_blocks") + F.greatest("_own", "_with"))
        .drop("_n")
    )


def _sets(words: int):
    """Texts' shingle hashes, once a text, for its places in blocks; rows that share an id may have other texts, which are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            found = [shingler(t) for t in batch["text"].tolist()]
            keep = [k for k, ((name, _), asked) in enumerate(zip(found, batch["words"].tolist(), strict=True)) if name == asked]
            yield pd.DataFrame({"key": batch["key"].to_numpy()[keep], "shingles": pd.Series([found[k][1].tobytes() for k in keep], dtype=object)})

    return run


def _exact(similarity: float):
    """Rows of one (scope, part): links of each member there, and spanning links.

    Where the scope is a node, a pair that shares an earlier node too (column paths has each member's nodes) was compared there.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("key")  # rows that share an id and a text
        keys, own = rows["key"].to_numpy(np.int64), rows["_own"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        n = len(sets)
        blocks, part = int(rows["_blocks"].iloc[0]), int(rows["part"].iloc[0])
        sizes = np.array([len(s) for s in sets], np.float64)
        both = np.zeros((n, n), np.float32)
        if n > 1:
            row = np.repeat(np.arange(n), sizes.astype(np.int64))
            values, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = times > 1  # a shingle of one text is in no intersection
            number = np.cumsum(shared) - 1
            keep = shared[token]
            row, token = row[keep], number[token[keep]]
            order = np.argsort(token, kind="stable")
            row, token = row[order], token[order]
            width = 4096
            for low in range(0, int(shared.sum()), width):
                a, b = np.searchsorted(token, [low, low + width])
                matrix = np.zeros((n, width), np.float32)
                matrix[row[a:b], token[a:b] - low] = 1
                both += matrix @ matrix.T
        union = sizes[:, None] + sizes[None, :] - both
        near = both >= similarity * union - 1e-9
        np.fill_diagonal(near, False)
        if part // blocks != part % blocks:  # pairs within one block are those of its own part
            near &= own[:, None] != own[None, :]
        node = rows["node"].iloc[0]
        if not pd.isna(node):
            shared: dict[int, list[int]] = {}
            for k, path in enumerate(rows["paths"]):
                for x in path:
                    if x < node:
                        shared.setdefault(int(x), []).append(k)
            for members in shared.values():
                if len(members) > 1:
                    near[np.ix_(members, members)] = False
        root = np.arange(n)
        for k in range(n):
            others = np.unique(root[near[k]])
            others = others[others != root[k]]
            if len(others):
                root[np.isin(root, np.append(others, root[k]))] = min(root[k], others.min())
        return pd.DataFrame({"key": keys, "links": near.sum(axis=1).astype(np.int64), "root": keys[root]})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: id_col, class_id, copy_id, n_copies, n_links.

    copy_id is the least id among texts with the same words (case and marks apart), n_copies their number. n_links
    counts the other distinct texts whose shingle sets have at least the similarity; class_id is the least id
    connected through such links and copies. Texts without words (null too) are copies of each other and have no links;
    texts shorter than a shingle have one shingle of all their words. Repeated rows are copies; an empty table gives an empty result; other
    columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # ids travel through pandas as text: a null among them would make long ids floats
    named_texts = texts.withColumn("id", F.col("id").cast("string"))
    sketched = stash(named_texts.mapInPandas(_sketch(words), "id string, words string, sketch binary, roots binary").withColumn("id", F.col("id").cast(kind)), "sketches")
    classes = sketched.groupBy("words").agg(F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"), F.min("sketch").alias("sketch"), F.min("roots").alias("roots"))
    # a number for each class: the graph's rows carry it instead of the words' digest
    classes = stash(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
    reps = classes.where(F.col("sketch").isNotNull()).select("key", "sketch", "roots")

    least = least_equal(similarity)
    searched = leaves(reps, similarity=similarity)
    nodes = _blocks(searched, "node", NODE_BLOCK).select("node", "part", "key")
    members = nodes.join(reps.select("key", "sketch"), "key").select("node", "part", "key", "sketch")
    members = members.repartition("node", "part").sortWithinPartitions("node", "part")
    likely = connected(members.mapInPandas(_brute(least), "a long, b long"), "likely")

    asked = stash(likely.join(classes.select("key", "words", "copy_id"), "key"), "asked")
    # every text is read at the row that names its class
    sets = texts.join(asked.select(F.col("copy_id").alias("id"), "key", "words").hint("shuffle_hash"), "id").select("key", "words", "text").mapInPandas(_sets(words), "key long, shingles binary")
    sized = asked.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    large = stash(sized.where(F.col("members") > WHOLE).select("root"), "large")
    scoped = asked.select("key", "root").join(large, "root", "left_anti").select("key", F.col("root").alias("scope"), F.lit(None).cast("long").alias("node"), F.lit(None).cast("array<long>").alias("paths"))
    if not large.isEmpty():
        inside = asked.select("key", "root").join(large, "root", "left_semi").join(searched.distinct(), "key")
        paths = inside.groupBy("key").agg(F.collect_list("node").alias("paths"))
        scoped = scoped.unionByName(inside.join(paths, "key").select("key", F.xxhash64("root", "node").alias("scope"), "node", "paths"))
    parts = _blocks(scoped, "scope", BLOCK).select("scope", "part", "key", "_own", "_blocks", "node", "paths")
    compared = parts.join(sets.dropDuplicates(["key"]).hint("shuffle_hash"), "key").groupBy("scope", "part").applyInPandas(_exact(similarity), "key long, links long, root long")
    compared = stash(compared, "compared")
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    groups = connected(compared.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")), "groups")
    firsts = groups.join(classes.select("key", "copy_id"), "key").groupBy("root").agg(F.min("copy_id").alias("class_id"))
    grouped = groups.join(firsts, "root").select("key", "class_id")
    named = classes.select("words", "key", "copy_id", "n_copies").join(links, "key", "left").join(grouped, "key", "left")
    named = named.select("words", F.coalesce("class_id", "copy_id").alias("class_id"), "copy_id", "n_copies", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    return sketched.select("id", "words").join(named, "words").select(F.col("id").alias(id_col), "class_id", "copy_id", "n_copies", "n_links")
