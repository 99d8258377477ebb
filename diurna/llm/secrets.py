"""Secret scan in Spark expressions only: fixed patterns plus sliding-window Shannon entropy.

Places are found without a position-returning function: the pieces that split() leaves between the matches and
the matches that regexp_extract_all() returns alternate, so their lengths add up to each start and end.

Entropy: candidates are unbroken runs of at least 20 characters from ``[A-Za-z0-9+/_=-]`` with a digit.
Allow-listed ones are suppressed; over the others a window of 20 characters moves by one
character at a time. The counts of the window's characters are kept from step to step, packed into a few numbers with five bits for each character,
and so is the sum of c*log2(c) over them: a step takes one from the count of the character that leaves and adds one to that of the character that
enters. A window counts when its entropy reaches the
bound of the candidate's character class; the span runs from the first such window to the end of the last.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the matches of AKIA[A-Z0-9]+ that have 20 characters
HEX = r"[0-9a-f]{24,}"  # the matches of [0-9a-f]+ that have 24 characters
ASSIGN_LEAST = 6

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: The candidates' characters by code, the first and the last; counts up to WINDOW take five bits, twelve of them a number
FIRST_CODE, LAST_CODE = ord("+"), ord("z")
BITS, PER_NUMBER = 5, 12
#: Matches whose places are added up at once
PART = 128
#: (name, whole-candidate pattern, least bits per character in a window); the first that matches holds
CLASSES = [
    ("hexadecimal", "^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("one case", "^([0-9a-z]+|[0-9A-Z]+)$", 3.4),
    ("any", "", 3.6),
]
#: Candidates that are not secrets
ALLOW = [
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    "^[0-9+/_=-]+$",  # numbers, dates, rules
    "^([A-Za-z]+|[0-9]+)([+/_=-]+([A-Za-z]+|[0-9]+))*[+/_=-]*$",  # words and numbers between marks: slugs, paths
    "^[A-Za-z]+[0-9]{1,4}$|^[0-9]{1,4}[A-Za-z]+$",  # a word with a short number
    "(?i)example|sample|placeholder|changeme|dummy|your[_-]|xxxx",
    "(?i)abcdefgh|01234567|12345678|qwerty",
]
KINDS = ["assign", "access", "hex", "entropy"]


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """regexp_extract_all, which is not run at all where nothing matches."""
    none = F.array().cast("array<string>")
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none)


def _bind(value: Column, body) -> Column:
    """body(value), with the value worked out once however often body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _places(text: Column, pattern: str, found: Column) -> Column:
    """array<struct<start, end, match>> of the matches, in code points, end exclusive.

    Places are added up inside parts of PART matches and the parts' lengths then, so that no long array is copied at every match.
    """
    kind = "array<struct<start:int,end:int,match:string>>"
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda b, m: F.struct(F.char_length(b).alias("gap"), F.char_length(m).alias("n"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + pair["gap"]
        end = begin + pair["n"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), pair["m"].alias("match")))).alias("out"))

    def parts(all_pairs: Column) -> Column:
        last = F.floor((F.size(all_pairs) - 1) / PART).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(all_pairs, k * PART + 1, F.lit(PART)), start, step))

    def moved(found_parts: Column) -> Column:
        offsets = F.aggregate(found_parts, F.array(F.lit(0)), lambda acc, part: F.concat(acc, F.array(F.element_at(acc, -1) + part["at"])))
        shift = lambda p, by: F.struct((p["start"] + by).alias("start"), (p["end"] + by).alias("end"), p["match"].alias("match"))
        both = F.zip_with(found_parts, F.slice(offsets, 1, F.size(found_parts)), lambda part, by: F.transform(part["out"], lambda p: shift(p, by)))
        return F.flatten(both)

    return F.when(F.size(found) > 0, _bind(pairs, lambda p: _bind(parts(p), moved))).otherwise(F.array().cast(kind))


def _weight(count: Column) -> Column:
    """c*log2(c) of a count within the window."""
    return F.element_at(F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(WINDOW + 1)]), count + 1)


def _one(code: Column) -> Column:
    """One of a character, within its number."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), code % PER_NUMBER * BITS)


def _number(code: Column) -> Column:
    return F.floor(code / PER_NUMBER).cast("int")


def _count(counts: Column, code: Column) -> Column:
    return F.call_function("shiftright", F.get(counts, _number(code)), code % PER_NUMBER * BITS).bitwiseAND(F.lit((1 << BITS) - 1).cast("long")).cast("int")


def high_windows(chars: Column, least_bits: Column) -> Column:
    """struct<s, first, last>: offsets of the first and the last window of chars (an array of WINDOW or more) that reach least_bits; -1 if none does."""

    def state(counts: Column, s: Column, first: Column, last: Column) -> Column:
        return F.struct(counts.alias("counts"), s.alias("s"), first.cast("int").alias("first"), last.cast("int").alias("last"))

    def change(acc: Column, code: Column, by: int) -> Column:
        """acc with one more or one fewer of a character."""
        counts = F.transform(acc["counts"], lambda x, i: F.when(i == _number(code), x + by * _one(code)).otherwise(x))
        s = _bind(_count(acc["counts"], code), lambda n: acc["s"] + _weight(n + by) - _weight(n))
        return state(counts, s, acc["first"], acc["last"])

    def mark(acc: Column, k: Column) -> Column:
        high = acc["s"] <= WINDOW * (math.log2(WINDOW) - least_bits) + 1e-9
        return state(acc["counts"], acc["s"], F.when(high & (acc["first"] < 0), k).otherwise(acc["first"]), F.when(high, k).otherwise(acc["last"]))

    def scan_codes(codes: Column) -> Column:
        none = F.array(*[F.lit(0).cast("long")] * -(-(LAST_CODE - FIRST_CODE + 1) // PER_NUMBER))
        empty = state(none, F.lit(0.0), F.lit(-1), F.lit(-1))
        filled = F.aggregate(F.slice(codes, 1, WINDOW), empty, lambda acc, code: change(acc, code, 1))

        def move(acc: Column, k: Column) -> Column:
            """The window that begins at k, from the one before it."""
            gone, come = F.get(codes, k - 1), F.get(codes, k + WINDOW - 1)
            return _bind(F.when(gone == come, acc).otherwise(_bind(change(acc, gone, -1), lambda rest: change(rest, come, 1))), lambda moved: mark(moved, k))

        later = F.when(F.size(codes) > WINDOW, F.sequence(F.lit(1), F.size(codes) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(later, _bind(filled, lambda acc: mark(acc, F.lit(0))), move)

    return _bind(F.transform(chars, lambda c: F.ascii(c) - FIRST_CODE), scan_codes)


def _least_bits(candidate: Column) -> Column:
    out = F.lit(CLASSES[-1][2])
    for _, pattern, bits in reversed(CLASSES[:-1]):
        out = F.when(candidate.rlike(pattern), F.lit(bits)).otherwise(out)
    return out


def _suspicious(candidate: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOW:
        allowed = allowed | candidate.rlike(pattern)
    return ~allowed


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col and ``spans``, array<struct<start, rank, end, kind>> in order of start, then kind.

    Kinds: assign, access, hex (fixed patterns, leftmost non-overlapping per kind) and entropy. Null and empty texts have no span;
    repeated rows, also of one id or of a null one, are scanned each for itself; very long texts are scanned whole, in time that grows with their length
    and matches; an empty table gives an empty result; other columns are ignored. Spans of different kinds may overlap, and each is reported.
    """
    t = F.col("_t")
    frame = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    frame = frame.select(
        "_id",
        "_t",
        _matches(t, ASSIGN).alias("_assign"),
        _matches(t, ASSIGN, 2).alias("_value"),
        _matches(t, ACCESS).alias("_access"),
        _matches(t, HEX).alias("_hex"),
        _matches(t, CANDIDATE).alias("_cand"),
    )

    def tagged(places: Column, kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(rank).alias("rank"), p["end"].alias("end"), F.lit(kind).alias("kind")))

    assign = F.filter(
        F.zip_with(_places(t, ASSIGN, F.col("_assign")), F.col("_value"), lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.char_length(v).alias("n"))),
        lambda p: p["n"] >= ASSIGN_LEAST,
    )
    # each transform below makes an array of its own, so that nothing is worked out again in the next one's steps
    odd = F.filter(_places(t, CANDIDATE, F.col("_cand")), lambda p: _suspicious(p["match"]))
    spelled = F.transform(odd, lambda p: F.struct(p["start"].alias("start"), F.slice(F.split(p["match"], ""), 1, F.char_length(p["match"])).alias("chars"), _least_bits(p["match"]).alias("bits")))
    windows = F.transform(spelled, lambda p: F.struct(p["start"].alias("start"), high_windows(p["chars"], p["bits"]).alias("high")))
    entropy = F.transform(
        F.filter(windows, lambda p: p["high"]["first"] >= 0),
        lambda p: F.struct((p["start"] + p["high"]["first"]).alias("start"), (p["start"] + p["high"]["last"] + WINDOW).alias("end")),
    )
    return frame.select(
        F.col("_id").alias(id_col),
        F.array_sort(
            F.concat(
                tagged(assign, "assign"),
                tagged(_places(t, ACCESS, F.col("_access")), "access"),
                tagged(_places(t, HEX, F.col("_hex")), "hex"),
                tagged(entropy, "entropy"),
            )
        ).alias("spans"),
    )


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, the digest of the fixed patterns' spans and all spans as text, per row; cases as in scan()."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["rank"] < KINDS.index("entropy"))
    return scan(docs, id_col, text_col).select(
        F.col(id_col),
        *[count(k) for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
