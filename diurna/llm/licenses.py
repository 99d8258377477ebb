"""License notices: exact phrases by words, and fuzzy search for short notices.

Texts are lower-cased (A-Z) and read as words, joined by one space. A notice of m characters with k edits
allowed is cut into k+1 pieces (pigeonhole: one of them survives any k edits unchanged). Each piece is
looked for exactly; only around the places where one occurs does the regex library's bounded-error
matching ``(?:notice){e<=k}`` verify the edits and give the span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Phrases and labels of the exact search (fixed values)
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Notices, labels and the edits allowed in the fuzzy search
NOTICES = [
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("gnu affero general public license", "agpl", 3),
    ("apache license", "apache", 1),
    ("licensed under the apache license", "apache", 4),
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 8),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 9),
    ("licensed under cc by", "cc-by", 2),
    ("creative commons attribution", "cc-by", 3),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("boost software license", "bsl", 2),
    ("this is free and unencumbered software released into the public domain", "unlicense", 7),
]
# In UTF-8 the bytes of characters beyond ASCII all count as parts of words, so bytes and code points give the same words
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_CHAR = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

HIT = "struct<label:string,phrase:string,first_word:long,last_word:long,start:long,end:long,edits:int>"
SCHEMA = f"n_words long, base array<{HIT}>, fuzzy array<{HIT}>"


@cache
def _exact() -> list[tuple[bytes, re.Pattern, str, str, int]]:
    """(a word that any place has, pattern, label, phrase, words)"""
    out = []
    for phrase, label in PHRASES:
        words = phrase.encode().split()
        out.append((max(words, key=len), re.compile(rb"(?<!%s)%s(?!%s)" % (_CHAR, _GAP.join(map(re.escape, words)), _CHAR)), label, phrase, len(words)))
    return out


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """(offset, piece): the notice cut into edits + 1 parts of nearly one length."""
    n, data = len(notice), notice.encode()
    cuts = [n * k // (edits + 1) for k in range(edits + 2)]
    return [(a, data[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@cache
def _fuzzy():
    import regex

    return [(notice, label, edits, pieces(notice, edits), regex.compile(rb"(?e)(?<!%s)(?:%s){e<=%d}(?!%s)" % (_CHAR, regex.escape(notice, special_only=True).encode(), edits, _CHAR))) for notice, label, edits in NOTICES]


def _windows(joined: bytes, notice: str, edits: int, seeds: list[tuple[int, bytes]]) -> list[list[int]]:
    """Merged parts of the joined words that hold any match, each with one byte of context and more around it."""
    found = []
    for offset, seed in seeds:
        at = joined.find(seed)
        while at >= 0:
            found.append((max(0, at - offset - edits - 1), min(len(joined), at - offset + len(notice) + edits + 1)))
            at = joined.find(seed, at + 1)
    found.sort()
    merged: list[list[int]] = []
    for low, high in found:
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
        else:
            merged.append([low, high])
    return merged


def fuzzy_places(joined: bytes) -> list[tuple[int, int, str, str, int]]:
    """(start, end, label, notice, edits) in the joined words."""
    out = []
    for notice, label, edits, seeds, pattern in _fuzzy():
        for low, high in _windows(joined, notice, edits, seeds):
            for m in pattern.finditer(joined, low, high):
                start, end = m.span()
                start += joined[start:end].startswith(b" ")
                end -= joined[start:end].endswith(b" ")
                out.append((start, end, label, notice, sum(m.fuzzy_counts)))
    return out


def _running(offsets: set[int], measure) -> dict[int, int]:
    """measure(0, offset) of each offset, added up part by part."""
    out, total, last = {}, 0, 0
    for at in sorted(offsets):
        total += measure(last, at)
        out[at], last = total, at
    return out


def search(text: str | None) -> tuple[int, list[tuple], list[tuple]]:
    """Number of words, places of the exact phrases, places of the fuzzy notices, both as HIT."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z alone
    words = _WORD.findall(data)
    joined = b" ".join(words)
    exact = [(m, label, phrase, n) for rare, pattern, label, phrase, n in _exact() if rare in data for m in pattern.finditer(data)]
    places = fuzzy_places(joined)
    if not exact and not places:
        return len(words), [], []
    spans = [m.span() for m in _WORD.finditer(data)]
    number = {s: k for k, (s, _) in enumerate(spans)}
    found = [(label, phrase, number[m.start()], number[m.start()] + n - 1, 0) for m, label, phrase, n in exact]
    ends = _running({a for a, *_ in places} | {b for _, b, *_ in places}, lambda low, high: joined.count(b" ", low, high))
    close = [(label, notice, ends[a], ends[b], edits) for a, b, label, notice, edits in places]
    # each part of the text between two places is decoded once
    chars = _running({at for _, _, first, last, _ in [*found, *close] for at in (spans[first][0], spans[last][1])}, lambda low, high: len(data[low:high].decode("utf-8", "surrogatepass")))

    def hit(label: str, phrase: str, first: int, last: int, edits: int) -> tuple:
        return (label, phrase, first, last, chars[spans[first][0]], chars[spans[last][1]], edits)

    base, fuzzy = [hit(*h) for h in found], [hit(*h) for h in close]
    order = lambda h: (h[2], h[3], h[0], h[1])
    return len(words), sorted(base, key=order), sorted(fuzzy, key=order)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_words, base and fuzzy (arrays of HIT; spans in code points, end exclusive).

    Null and empty texts have no word and no place; repeated rows, also of one id or of a null one, are scanned each for itself; very long texts are
    scanned whole; an empty table gives an empty result; other columns are ignored. Places of different phrases may overlap; those of one don't.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [search(t) for t in batch["text"]]
            names = ("label", "phrase", "first_word", "last_word", "start", "end", "edits")
            as_rows = lambda hits: [dict(zip(names, h, strict=True)) for h in hits]
            yield pd.DataFrame({"id": batch["id"], "n_words": [f[0] for f in found], "base": [as_rows(f[1]) for f in found], "fuzzy": [as_rows(f[2]) for f in found]})

    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id string, {SCHEMA}").select(F.col("id").cast(kind).alias(id_col), "n_words", "base", "fuzzy")


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, labels and a score per row: 1 where a phrase stands exactly, else 1 - edits / length of the best notice, else 0."""
    labels = lambda hits: F.transform(hits, lambda h: h["label"])
    join = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    base, fuzzy = F.col("base"), F.col("fuzzy")
    best = F.array_max(F.transform(fuzzy, lambda h: 1.0 - h["edits"] / F.char_length(h["phrase"])))
    return license_scan(docs, id_col, text_col).select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["first_word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["first_word"])).alias("last_word"),
        join(labels(base)).alias("base_labels"),
        join(F.concat(labels(base), labels(fuzzy))).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
        F.size(fuzzy).cast("long").alias("n_fuzzy"),
    )
