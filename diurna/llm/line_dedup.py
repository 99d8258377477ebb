"""Removal of repeated multi-line chunks with content-defined boundaries.

A text's lines are hashed; a rolling hash over the last ``ROLL`` line hashes ends a chunk where it is divisible by
``EXPECTED``. So boundaries depend on nearby lines alone and come back in step after lines are put in or taken
out. A line of ``LONG_LINE`` or more words is a chunk of its own (a passage). Chunks of one shorter line never count.

Passages wrapped over several lines are found at any line: from every line the fewest lines with ``LONG_LINE`` words
are a window, and so are the fewest that end there. The windows inside a repeated run of so many words cover all of
it, so the run goes whole. Windows overlap; all that follows treats them as chunks.

Steps: chunk hashes are counted over all documents (pre-aggregated before the shuffle); for hashes that occur
again, the chunks' bytes are grouped and compared, so that a hash alone never removes text; then each document drops
the chunks whose bytes an earlier place has. The place that stays is the first one in the document of the smallest id.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stash

ROLL = 2
EXPECTED = 3
LEAST_LINES = 2
MOST_LINES = 64
LONG_LINE = 50
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_TOP = pow(_BASE, ROLL - 1, 1 << 64)


def chunks(text: str) -> list[tuple[int, int]]:
    """(first, end) of the chunks, as numbers of lines."""
    out, first, rolled, value = [], 0, deque(), 0
    lines = text.split("\n")

    def cut(end: int) -> None:
        nonlocal first, value
        if first < end:
            out.append((first, end))
        first, value = end, 0
        rolled.clear()

    for k, line in enumerate(lines):
        # as many words as spaces at most, plus one; counted only where that may be enough
        if line.count(" ") >= LONG_LINE - 1 and len(line.split()) >= LONG_LINE:
            cut(k)
            cut(k + 1)
            continue
        # the hash rolls: the line that leaves the last ROLL ones is taken out of it, the new one put in
        if len(rolled) == ROLL:
            value -= rolled.popleft() * _TOP
        rolled.append(xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")))
        value = (value * _BASE + rolled[-1]) & _MASK
        n = k + 1 - first
        if n >= MOST_LINES or n >= LEAST_LINES and (value >> 20) % EXPECTED == 0:
            cut(k + 1)
    cut(len(lines))
    return out


def _counts(lines: list[str], a: int, b: int) -> bool:
    return b - a >= LEAST_LINES or lines[a].count(" ") >= LONG_LINE - 1 and len(lines[a].split()) >= LONG_LINE


def windows(lines: list[str]) -> set[tuple[int, int]]:
    """(first, end) of the runs of lines with LONG_LINE words that would have fewer without their last line, or without their first."""
    sums = [0]
    for line in lines:
        sums.append(sums[-1] + len(line.split()))
    out = set()
    a = 0
    for b in range(1, len(sums)):
        # first lines from a on have too few words up to this end; those passed now have their fewest lines here
        was = a
        while a < b and sums[b] - sums[a] >= LONG_LINE:
            a += 1
        out.update((k, b) for k in range(was, a))
        if a:
            out.add((a - 1, b))
    return out


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def hashed(text: str) -> Iterator[tuple[int, int, int, bytes]]:
    """(first line, end, hash, bytes) of each chunk that counts and of each window."""
    lines = text.split("\n")
    for a, b in sorted({(a, b) for a, b in chunks(text) if _counts(lines, a, b)} | windows(lines)):
        data = "\n".join(lines[a:b]).encode("utf-8", "surrogatepass")
        yield a, b, _signed(xxhash.xxh64_intdigest(data)), data


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids, hashes, times = [], [], []
        for doc, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
            own: dict[int, int] = {}
            for *_, h, _data in hashed(text):
                own[h] = own.get(h, 0) + 1
            ids += [doc] * len(own)
            hashes += own
            times += own.values()
        yield pd.DataFrame({"id": pd.Series(ids, dtype=batch["id"].dtype), "hash": pd.Series(hashes, dtype="int64"), "times": pd.Series(times, dtype="int64")})


def _second(data: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(data, seed=42))


def _bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chunks of wanted hashes, each once per document."""
    for batch in batches:
        rows = []
        for doc, text, wanted in zip(batch["id"].tolist(), batch["text"].tolist(), batch["wanted"].tolist(), strict=True):
            wanted, own = set(wanted), {}
            for *_, h, data in hashed(text):
                if h in wanted:
                    own[data] = (h, own.get(data, (h, 0))[1] + 1)
            rows += [(doc, h, _second(data), data, n) for data, (h, n) in own.items()]
        yield pd.DataFrame(rows, columns=["id", "hash", "second", "data", "times"])


def _remove(text: str, drop) -> tuple[str, int, int, int]:
    """(text left, lines before, lines removed, chunks and windows removed); drop: (hash, second, own) of repeated chunks, own where this document's first one stays."""
    lines = text.split("\n")
    if drop is None or not len(drop):
        return text, len(lines), 0, 0
    verdict = {(d["hash"], d["second"]): d["own"] for d in drop}
    hashes = {h for h, _ in verdict}
    gone: list[tuple[int, int]] = []
    seen: set[bytes] = set()
    for a, b, h, data in hashed(text):
        if h not in hashes or (own := verdict.get((h, _second(data)))) is None:
            continue
        if not own or data in seen:
            gone.append((a, b))
        seen.add(data)
    out = {k for a, b in gone for k in range(a, b)}
    return "\n".join(x for k, x in enumerate(lines) if k not in out), len(lines), len(out), len(gone)


def _cleaned(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    rows = [_remove(text, drop) for text, drop in zip(texts.tolist(), drops.tolist(), strict=True)]
    return pd.DataFrame(rows, columns=["text", "n_lines", "lines_removed", "chunks_removed"])


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(hash, second, keeper, places) of chunks with the same bytes in several places, after comparison of the bytes; and (id, hash, times) of all chunks."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = stash(texts.where(F.col("id").isNotNull()).mapInPandas(_hashes, f"id {kind}, hash long, times long"), "chunk-hashes")
    again = found.groupBy("hash").agg(F.sum("times").alias("n")).where(F.col("n") > 1).select("hash")
    wanted = found.join(again, "hash", "left_semi").groupBy("id").agg(F.collect_set("hash").alias("wanted"))
    data = texts.join(wanted.hint("shuffle_hash"), "id").mapInPandas(_bytes, f"id {kind}, hash long, second long, data binary, times long")
    # one group per distinct bytes: whatever shares a group has been compared
    same = data.groupBy("hash", "second", "data").agg(F.min("id").alias("keeper"), F.sum("times").alias("places"))
    # two hashes that agree over different bytes decide nothing
    verdicts = (
        same.groupBy("hash", "second")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("keeper").alias("keeper"), F.sum("places").alias("places"))
        .where((F.col("texts") == 1) & (F.col("places") > 1))
        .select("hash", "second", "keeper", "places")
    )
    return verdicts, found


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: id_col, text without repeated chunks, n_lines (before), lines_removed, chunks_removed, and the columns to keep.

    Null counts as empty text. An empty text is one empty line and is left alone. Rows that repeat an id keep each
    other's chunks, once a row; rows with a null id are left as they are and don't count. A text all of whose chunks stand
    elsewhere becomes empty. A table without rows gives none. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    verdicts, found = repeated_chunks(docs, id_col, text_col)
    drop = (
        found.join(stash(verdicts, "verdicts"), "hash")
        .where((F.col("id") != F.col("keeper")) | (F.col("times") > 1))
        .groupBy("id")
        .agg(F.collect_list(F.struct("hash", "second", (F.col("id") == F.col("keeper")).alias("own"))).alias("drop"))
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep or [])])
    joined = texts.join(drop.hint("shuffle_hash"), "id", "left")
    cleaner = F.pandas_udf(_cleaned, "text string, n_lines long, lines_removed long, chunks_removed long")
    cleaned = joined.withColumn("c", cleaner("text", "drop"))
    return cleaned.select(F.col("id").alias(id_col), "c.text", "c.n_lines", "c.lines_removed", "c.chunks_removed", *[F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep or [])])
