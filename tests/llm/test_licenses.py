"""License scan: exact phrases against a plain version, fuzzy places against edit distances of all spans."""

import random
import re

import pytest

from diurna.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


CASES = [None, "", "GNU  General-Public\nLicense", "mit license mit license, cc by cc-by", "xmit license mit licenses", "éapache license apache license É", "Apache License apache license", "a" * 50000 + " cc by"]


@pytest.mark.parametrize("text", CASES)
def test_exact(text):
    n, base, _ = licenses.search(text)
    assert (n, sorted((h[2], h[0]) for h in base)) == plain(text)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def test_fuzzy_finds_edited_notices_and_nothing_else():
    rng = random.Random(5)
    for notice, label, edits in licenses.NOTICES:
        for _ in range(6):
            chars = list(notice)
            for _ in range(edits):
                k = rng.randrange(1, len(chars) - 1)
                if chars[k] != " ":
                    chars[k] = rng.choice("abcxyz")
            edited = "".join(chars)
            text = "Some words é before. " + edited.upper() + ", after"
            hits = [h for h in licenses.search(text)[2] if h[1] == notice]
            assert hits and hits[0][0] == label, (notice, edited)
            assert all(distance(" ".join(WORD.findall(text[h[4] : h[5]].lower())), notice) <= edits for h in hits)
    assert licenses.search("the general public may use this text without any license")[1:] == ([], [])


def test_insertions_deletions_and_edits_on_blanks():
    rng = random.Random(6)
    for notice, label, edits in licenses.NOTICES:
        for _ in range(8):
            chars = list(notice)
            for _ in range(rng.randrange(1, edits + 1)):
                k = rng.randrange(1, len(chars) - 1)
                kind = rng.randrange(3)
                if kind == 0:
                    chars[k] = rng.choice("abcxyz")
                elif kind == 1:
                    chars.insert(k, rng.choice("abcxyz "))
                else:
                    del chars[k]
            edited = " ".join("".join(chars).split())
            if distance(edited, notice) > edits:
                continue
            text = f"Words before, {edited.title()}; words after"
            place = (text.lower().index(edited), text.lower().index(edited) + len(edited))
            hits = [h for h in licenses.search(text)[2] if h[1] == notice]
            assert any(h[4] < place[1] and h[5] > place[0] for h in hits), (notice, edited)
            assert all(h[6] <= edits and distance(" ".join(WORD.findall(text[h[4] : h[5]].lower())), notice) <= edits for h in hits)


def test_places_side_by_side_and_many():
    both = licenses.search("mozila public license mozilla public license")[2]
    assert [(h[2], h[3], h[6]) for h in both] == [(0, 2, 1), (3, 5, 0)]
    n, base, fuzzy = licenses.search("é MIT license. " * 3000)
    assert n == 9000 and len(base) == 3000 and [h[4] for h in base] == [15 * k + 2 for k in range(3000)]
    assert "apache" in {h[0] for h in licenses.search("under the Apache Licence 2.0")[2]}


def test_report(spark):
    docs = spark.createDataFrame([(1, "Licensed under CC BY-NC 4.0."), (2, None), (3, "GNU Genral Public Licence"), (3, "GNU Genral Public Licence")], "doc_id long, text string").selectExpr("*", "1 as base", "'x' as id")
    rows = sorted(map(tuple, licenses.license_report(docs).collect()))
    assert rows[0] == (1, 7, 1, 2, 2, "cc-by", "cc-by", 1.0, 1)
    assert rows[1] == (2, 0, 0, None, None, "", "", 0.0, 0)
    assert rows[2] == rows[3] and rows[2][:7] == (3, 4, 0, None, None, "", "gpl") and 0.9 < rows[2][7] < 1
    assert licenses.license_report(docs.limit(0)).count() == 0
