"""Document functions: HTML, tables and slicing, case by case and by property."""

import difflib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from diurna.functions import markup, slicing, tables

HTML = [
    (None, ""),
    ("", ""),
    ("<body><h1 class='Titulo_1'>Act  one</h1></body>", "# Act one"),
    ("<div class='Titulo_1'>A</div><div class='ANOTACION'>B</div><h2>C</h2><h3>D</h3><h4>E</h4>", "# A\n\n## B\n\n## C\n\n### D\n\n### E"),
    ("<div class='titulo_1'>case matters</div>", "case matters"),
    ("<p>a <span style='FONT-WEIGHT: bold'>b </span><b>c</b><i> d </i>e</p>", "a **b c** *d* e"),
    ("<p><b><i>x</i></b></p>", "***x***"),
    ("<b>bare</b>", "bare"),
    ("<p>one<br>two</p><h1>one<br>two</h1>", "one\ntwo\n\n# one two"),
    ("<p>&amp; &lt;a&gt;  b</p>", "& <a> b"),
    ("<p> </p><h1> </h1>", ""),
    ("<div>text here<p>in</p>tail</div>", "text here\n\nin\n\ntail"),
    ("<ul><li>a</li><li>b</li></ul>", "ab"),
    ("<head><title>T</title><style>p{}</style></head><body><script>x()</script><p>y</p></body>", "y"),
    ("<title>T</title><p>y</p>", "T\n\ny"),
    ("<p>a<p>b</p></p><p>c</p>", "a\n\nb\n\nc"),
    ("<p>x</div></p>y", "x\n\ny"),
    ("<p><b><br></b></p>", "**\n**"),
    ("<p>a<!-- note -->b</p>", "a note b"),
    ("<span style='font-weight:bolder'>s</span><p><span style='font-weight:bolder'>s</span></p>", "s\n\n**s**"),
    ("<table><tr><th>h|1</th><th>h<br>2</th></tr><tr><td><b>x</b></td></tr></table>", "| h\\|1 | h 2 |\n|---|---|\n| **x** |  |"),
    ("<table><tr><td>o<table><tr><td>i</td></tr></table></td></tr></table>", "| oi |\n|---|\n| i |"),
    ("<table></table><p>z</p>", "z"),
]


@pytest.mark.parametrize(("source", "want"), HTML)
def test_html(source, want):
    assert markup.html_to_md(source) == want


def test_comments_can_be_dropped():
    assert markup.html_to_md("<!-- x --><p>a<!-- y --></p>", drop_comments=True) == "a"


TABLES = [
    (None, ""),
    ("no table", "no table"),
    ("a\n\n\n\nb", "a\n\nb"),
    ("a<TABLE><TR><TD colspan=2>x</TD></TR><tr><td>1<td>2</td></tr></TABLE>b", "a\n\n| x |  |\n|---|---|\n| 2 |  |\n\nb"),
    ("<table><tr><td rowspan='2'>x</td><td>y</td></tr><tr><td>z|&amp;</td></tr></table>", "\n\n| x | y |\n|---|---|\n|  | z\\|& |\n\n"),
    ("<table><tr><td>lost row</td></table>", "<table><tr><td>lost row</td></table>"),
    ("<table></table>", "<table></table>"),
    ("<table><tr><th>h</th></tr></table>", "\n\n| h |\n|---|\n\n"),
    ("| a |\n|---|", "| a |\n|---|"),
]


@pytest.mark.parametrize(("source", "want"), TABLES)
def test_tables(source, want):
    assert tables.tables_to_md(source) == want


@pytest.mark.parametrize(("value", "want"), [(None, 1), ("", 1), ("x", 1), ("0", 1), ("-3", 1), ("4", 4), (" 2 ", 2), ("1.5", 1)])
def test_span(value, want):
    assert tables.span(value) == want


@settings(max_examples=200, database=None)
@given(st.lists(st.lists(st.builds(tables.Cell, st.text("ab", max_size=2), st.integers(1, 4), st.integers(1, 4)), max_size=4), max_size=5))
def test_grid_is_rectangular_and_keeps_all_texts(rows):
    grid = tables.grid(rows)
    assert len(grid) == len(rows) and len({len(r) for r in grid}) <= 1
    assert sorted(t for r in grid for t in r if t) == sorted(c.text for r in rows for c in r if c.text)
    filled = {}  # every place by hand
    width = 0
    for r, row in enumerate(rows):
        c = 0
        for cell in row:
            while (r, c) in filled:
                c += 1
            for y in range(cell.down):
                for x in range(cell.across):
                    filled[r + y, c + x] = cell.text if x == y == 0 else ""
            c += cell.across
            width = max(width, c)
    assert grid == [[filled.get((r, c), "") for c in range(width)] for r in range(len(rows))]


def test_fold():
    folded = slicing.fold("  ÁRBOL **ﬁn**\n\n ½ [x]")
    assert folded.text == "arbol fin 1⁄2 x"
    assert len(folded.offsets) == len(folded.text) and folded.offsets.tolist() == sorted(folded.offsets.tolist())
    assert slicing.fold("# * |").text == ""


def test_exact_places_are_those_of_an_alignment():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("ab ", k=rng.randrange(5, 60)))
        folded = slicing.fold(text)
        if len(folded.text) < 4:
            continue
        a = rng.randrange(len(folded.text) - 2)
        title = folded.text[a : a + rng.randrange(2, 20)].strip()
        if not title:
            continue
        place = slicing.locate(folded, title)
        blocks = difflib.SequenceMatcher(None, folded.text, title, autojunk=False).get_matching_blocks()
        top = max(blocks, key=lambda b: b.size)
        assert (place.folded, place.confidence) == (top.a - top.b, sum(b.size for b in blocks) / len(title))


DOCUMENT = "tail of before\n\n# MINISTRY\n\n## Notice 1 of the land\nbody one\n\n# ENERGY\n\n### Notice 2 of the land\nbody two"
CUTS = [
    (("", "t", None), ""),
    ((None, "t", None), ""),
    (("  \n", "t", None), ""),
    ((DOCUMENT, "NOTICE 1 OF THE LAND", "Notice 2 of the land"), "## Notice 1 of the land\nbody one"),
    ((DOCUMENT, "Notice 2 of the land", None), "### Notice 2 of the land\nbody two"),
    ((DOCUMENT, None, "Notice 2 of the land"), "tail of before\n\n# MINISTRY\n\n## Notice 1 of the land\nbody one"),
    ((DOCUMENT, "Nótice 1 ~of~ thé lnd", "Notlce 2 of the land"), "## Notice 1 of the land\nbody one"),
    ((DOCUMENT, "zzzz qqqq", "kkkk wwww"), DOCUMENT),
    (("***", "t", "u"), "***"),
]


@pytest.mark.parametrize(("args", "want"), CUTS)
def test_cut(args, want):
    assert slicing.cut_note(*args) == want


def test_cut_gates():
    assert slicing.cut_note(DOCUMENT, "Notlce 1 of the lond", "Notice 2 of the land", min_confidence=0.99).startswith("tail of before")
    assert slicing.cut_note(DOCUMENT, "Notice 1 of the land", min_longest=100) == DOCUMENT
    lone = "a title\nx\n#\n## next one here\ny"
    assert slicing.cut_note(lone, "a title", "next one here") == "a title\nx\n#"


@settings(max_examples=150, database=None)
@given(st.text("abÁ #\n*", max_size=80), st.text("abá ", max_size=12), st.one_of(st.none(), st.text("abá ", max_size=12)))
def test_a_cut_is_part_of_its_text(text, title, following):
    assert slicing.cut_note(text, title, following) in text


def test_boundaries_report_the_longest_block():
    found = slicing.boundaries("x " * 5000 + "some other words entirely", "unrelated heading of sixty characters")
    assert found.start_longest < 10


def plain_fold(source):
    """fold() character by character."""
    text, offsets = [], []
    for at, folded in enumerate(map(slicing._fold, source)):
        if folded == " ":
            if text and text[-1] != " ":
                text.append(" ")
                offsets.append(at)
        else:
            text += folded
            offsets += [at] * len(folded)
    return "".join(text), offsets


@settings(max_examples=300, database=None)
@given(st.text(st.sampled_from("aÁ \n\t#*ﬁ½¨ﷺ𝒜é \ud800İß"), max_size=40))
def test_fold_character_by_character(source):
    folded = slicing.fold(source)
    assert (folded.text, folded.offsets.tolist()) == plain_fold(source)


def test_deep_and_odd_markup():
    deep = "<div>" * 5000 + "<p><b>" + "<i>" * 3000 + "x" + "</i>" * 3000 + "</b></p>" + "</div>" * 5000
    assert markup.html_to_md(deep) == "***x***"
    assert markup.html_to_md("<body>" + deep + "</body>") == "***x***"
    odd = tables.tables_to_md(f"<table><tr><td colspan='{'9' * 5000}'>a</td><td colspan='1500'>b</td></tr></table>").strip().split("\n")
    assert odd[0].count("|") == 1502 and odd[1].count("---") == 1501


def test_table_pieces():
    text = "a<table>b</table>c<TABLE x=1>d<table>e</table>f</table>g<table>h"
    assert list(tables.pieces(text)) == [(False, "a"), (True, "<table>b</table>"), (False, "c"), (True, "<TABLE x=1>d<table>e</table>"), (False, "f</table>g<table>h")]


def test_titles_one_behind_the_other():
    folded = slicing.fold("same title\nx\nsame title\ny\nsame title")
    assert [p.source for p in slicing.places(folded, ["same title", "Same Title", None, "same title"])] == [0, 13, None, 26]
