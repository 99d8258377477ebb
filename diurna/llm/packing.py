"""Best-fit packing of tokenised documents into fixed-length sequences by minimum bin slack.

Documents become token pieces in one pass over the texts (a bounded word cache in front of the
tokenizer: white space always ends a token of this vocabulary, so a text's ids are those of
its words). Only the pieces' lengths are shuffled, by a row number, into partitions of
about ``PIECES_PER_TASK`` pieces. Each is packed by itself: a bin takes the longest piece left, and
a subset-sum over the lengths available, held as the bits of one integer, finds the fullest
combination for the rest of it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stash

MAX_LENGTH = 2048
END_ID = 0
#: A task packs this many pieces: enough that all but the last bins fill up, and a few MB.
PIECES_PER_TASK = 150_000
#: Words the cache keeps at most (about 80 MB a worker).
CACHE_WORDS = 400_000

# Latin letters whose case and normal form depend on nothing around them, then one mark that is a token of its own
_WORD_AND_MARK = re.compile("([A-Za-zÀ-ÖØ-Þß-öø-ÿ]+)([.,;:!?]?)")
# str.split() splits at these, the tokenizer doesn't
_SEPARATORS = "\x1c\x1d\x1e\x1f"


class WordTokenizer:
    """Token ids of whole texts, as the tokenizer itself gives them, through a bounded cache of words."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words
        symbols = ByteLevel(add_prefix_space=False, use_regex=False)
        #: The model's symbols for the lower-case letters of _WORD_AND_MARK
        self.letters = {n: symbols.pre_tokenize_str(chr(n))[0][0] for n in range(97, 256) if chr(n).islower()}

    def _encode(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        """A run of lower-case letters is one piece for the model: the steps before it change nothing."""
        return np.asarray([t.id for t in self.tokenizer.model.tokenize(word.translate(self.letters))], dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        cache = self.cache
        m = _WORD_AND_MARK.fullmatch(word)
        if not m:
            ids = self._encode(word)
        else:
            base, mark = m[1].lower(), m[2]
            ids = cache.get(base)
            if ids is None:
                ids = cache[base] = self._letters(base)
            if mark:
                ids += cache.get(mark) or cache.setdefault(mark, self._encode(mark))
        if len(cache) >= self.cache_words:
            cache.clear()
        if len(word) <= 64:
            cache[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        if any(c in text for c in _SEPARATORS):
            return self._encode(text)
        get, word = self.cache.get, self._word
        return b"".join([get(w) or word(w) for w in text.split()])


def _tokenise(path: str, max_length: int, end_id: int, keep_ids: bool):
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, width = WordTokenizer(path), 4 * max_length
        for batch in batches:
            rows: list[tuple] = []
            ids: list[bytes] = []
            for doc, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                data = tokenizer.ids(text) + end
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    if keep_ids:
                        ids.append(part)
            out = pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])
            if keep_ids:
                out["ids"] = ids
            yield out

    return run


def fill_bins(counts: dict[int, int], capacity: int) -> Iterator[list[int]]:
    """Bins as lists of lengths, until all pieces counted by length are used.

    Each bin starts with the longest piece left. Bit s of ``reach`` says that some of the pieces
    looked at, longest first, sum to s; the search ends when the free space is met exactly or no piece is left.
    """
    left = {n: c for n, c in counts.items() if c}
    order = sorted(left, reverse=True)
    while order:
        top = order[0]
        bin_, free = [top], capacity - top
        left[top] -= 1
        if free:
            mask, reach, steps = (1 << (free + 1)) - 1, 1, []
            for n in order:
                if n > free:
                    continue
                for _ in range(min(left[n], free // n)):
                    grown = (reach | (reach << n)) & mask
                    if grown == reach:
                        break
                    steps.append((n, reach))
                    reach = grown
                if reach >> free:
                    break
            total = reach.bit_length() - 1
            for n, before in reversed(steps):
                if not total:
                    break
                if not (before >> total) & 1:
                    bin_.append(n)
                    left[n] -= 1
                    total -= n
        if any(left[n] == 0 for n in set(bin_)):
            order = [n for n in order if left[n]]
        yield bin_


def _pack(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b for b in batches if len(b)] or [pd.DataFrame({"row": [], "length": []})])
        if not len(rows):
            return
        rows = rows.sort_values(["length", "row"], kind="stable").reset_index(drop=True)
        row, length = rows["row"].to_numpy(np.int64), rows["length"].to_numpy(np.int64)
        values, first, count = np.unique(length, return_index=True, return_counts=True)
        after = {int(v): int(f) for v, f in zip(values, first, strict=True)}  # next unused row of each length
        sequence, offset = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
        for bin_ in fill_bins({int(v): int(c) for v, c in zip(values, count, strict=True)}, capacity):
            at, name = 0, row[after[bin_[0]]]
            for n in bin_:
                k = after[n]
                after[n] = k + 1
                sequence[k], offset[k] = name, at
                at += n
        rows["sequence_id"], rows["offset"] = sequence, offset
        yield rows

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(row, id, piece, start, length, ids_crc32[, ids]): the documents' tokens and an end id, cut at max_length; row numbers pieces."""
    # ids travel through pandas as text: a null among them would make long ids floats
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "id string, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    pieces = texts.mapInPandas(_tokenise(tokenizer_path, max_length, end_id, keep_ids), schema)
    return pieces.withColumn("row", F.monotonically_increasing_id())


def pack(docs: DataFrame, tokenizer_path: str, max_length: int = MAX_LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset and, if asked for, ids (binary, little-endian 32-bit).

    Null and empty texts are one piece that holds the end id. Repeated rows are packed as documents of their own. Texts
    of over max_length tokens are cut into pieces of that length, the last one shorter; no token is dropped.
    A table without rows gives none; other columns are ignored. sequence_id is the number of the sequence's first piece.
    """
    small_batches(docs.sparkSession)
    pieces = stash(token_pieces(docs, tokenizer_path, max_length, end_id, id_col, text_col, keep_ids), "pieces")
    tasks = max(1, -(-pieces.count() // PIECES_PER_TASK))
    kind = docs.schema[id_col].dataType.simpleString()
    columns = ["row", "id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    schema = "row long, id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids + ", sequence_id long, offset long"
    packed = pieces.select(*columns).repartition(tasks, "row").mapInPandas(_pack(max_length), schema)
    return packed.select(F.col("id").cast(kind).alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)
