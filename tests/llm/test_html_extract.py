"""HTML extraction: pages with known articles, tree matching against all matchings, and odd inputs."""

import html
import itertools
import random

from diurna.llm import html_extract as hx


def page(rng, site, blocks, article=True, close=True):
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(site, 3))
    body = "".join(f"<p>{html.escape(b)}" + ("</p>" if close else "") for b in blocks[1:])
    main = f"<h1>{html.escape(blocks[0])}</h1>{body}"
    main = f"<article>{main}<form><input name=q> Subscribe</form><p>Shared by {site[0]} Press</p><div class='comments'><p>first!</p></div></article>" if article else f"<div class=x>{main}</div>"
    return (
        f"<!DOCTYPE html><html><head><title>{html.escape(blocks[0])}</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body>"
        f"<header><h1>{site[0]}</h1></header><nav><ul>{nav}</ul></nav><!-- <p>no</p> --><div class=\"ad top\">buy {rng.random()}</div><div>All about {site[0]}</div>{main}"
        f"<aside>see also</aside><footer>&copy; {site[0]}</footer></body></html>"
    )


def blocks(rng, n):
    words = ["alpha", "b&b", "c<d", "déjà", "x > y", "“q”", "nine"]
    return [" ".join(rng.choices(words, k=rng.randrange(3, 12))) + f" {rng.random()}" for _ in range(n)]


def test_pages_with_known_articles(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(60):
        site = [f"Site{k % 3}", "red", "green", "blue", "black"]
        b = blocks(rng, rng.randrange(2, 9))
        rows.append((k, f"https://h{k % 3}.example.com/{k}", page(rng, site, b, article=k % 3 != 2, close=k % 2 == 0)))
        want[k] = "\n".join(b)
    rows += [(100, None, rows[0][2]), (101, "https://h0.example.com/n", None), (102, "https://h0.example.com/e", ""), (103, "no url", "<p>a&nbsp; b<br>c<p>d"), (0, rows[0][1], rows[0][2])]
    want |= {100: want[0] + "\nShared by Site0 Press", 101: "", 102: "", 103: "a b c\nd"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as _0", "'t' as wrapper")
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in hx.extract(pages).collect()]
    assert len(got) == len(rows)
    for k, text, n in got:
        assert (text, n) == (want[k], len(want[k])), k
    assert hx.extract(pages.limit(0)).count() == 0


def test_large_wrappers_take_the_salted_join(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, f"https://h{k % 2}.example.com/{k}", page(rng, [f"S{k % 2}", "a", "b", "c"], blocks(rng, 4))) for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    small = sorted(map(tuple, hx.extract(pages).collect()))
    monkeypatch.setattr(hx, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, hx.extract(pages).collect())) == small


def extracted(spark, pages, host="h.example.com"):
    rows = [(k, f"https://{host}/{k}", p) for k, p in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in hx.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_copies_of_one_article_are_kept(spark):
    rng = random.Random(5)
    b = blocks(rng, 6)
    got = extracted(spark, [page(rng, ["S", "a", "b", "c"], [*b[:-1], b[-1] + str(k)]) for k in range(6)])
    assert got[0].split("\n")[:6] == [*b[:-1], b[-1] + "0"]


def test_the_wrapper_alone_decides_where_nothing_is_named(spark):
    rng = random.Random(7)
    pages, want = [], {}
    for k in range(40):
        b = blocks(rng, rng.randrange(2, 7))
        title = f"title {k} {rng.random()}"
        rows = "".join(f"<div class=r9>{html.escape(x)}</div>" for x in b)
        lead = f"<div class=q1><div class=q2>{html.escape(title)}</div></div>" if k % 2 else ""
        pages.append(
            f"<html><body><div class=a1><div class=b1>The Daily Site</div><div class=b2>Start</div><div class=b3>{rng.choice('abc')}</div></div>"
            f"<div class=c1><div class=c2>{lead}<div class=c4>{rows}</div><div class=c5>Tell your friends</div></div></div><div class=e1>All rights reserved</div></body></html>"
        )
        want[k] = "\n".join(b)
    got = extracted(spark, pages)
    assert got == want
    unhelped = [hx.main_text(p) for p in pages]
    assert all("All rights reserved" in u and u != want[k] for k, u in enumerate(unhelped))


def test_a_small_layout_of_a_large_host_has_its_own_wrapper(spark):
    rng = random.Random(8)
    pages, want = [], {}
    for k in range(150):
        b = blocks(rng, 4)
        rows = "".join(f"<p>{html.escape(x)}</p>" for x in b)
        pages.append(f"<body><div class=x1><p>Always here</p></div><div class=x2>{rows}</div></body>" if k % 30 else f"<body><section class=y1><p>Never there</p></section><section class=y2>{rows}</section></body>")
        want[k] = "\n".join(b)
    assert extracted(spark, pages) == want


def test_a_text_that_some_pages_share_stays(spark):
    rng = random.Random(9)
    pages, want = [], {}
    for k in range(30):
        b = [*blocks(rng, 3), *(["Of the same series"] if k % 3 else [])]
        pages.append(f"<article><h1>{html.escape(b[0])}</h1><p>Follow us</p>" + "".join(f"<p>{html.escape(x)}</p>" for x in b[1:]) + "</article>")
        want[k] = "\n".join(b)
    assert extracted(spark, pages) == want


def test_headings_of_an_article():
    assert hx.main_text('<article><div class="entry-header"><h1>Title</h1></div><p>body</p><div class="post-comments"><p>no</p></div></article>') == "Title\nbody"
    assert hx.main_text('<article><div class="notice">no</div><p>body</p><div class="cookie-notice">no</div></article>') == "body"


def test_deep_and_wide_pages():
    deep = "<div>" * 5000 + "deep<p>x" + "</p></div>" * 5000 + "tail"
    assert hx.main_text(deep) == "deep\nx\ntail"
    wrapper = hx.Slot.load(hx.json.loads(hx.skeleton([deep, deep + "1", deep + "2"])))
    assert hx.sightings(deep, wrapper)
    wide = ["<body>" + "".join(f"<div class=c{chr(97 + (k * j) % 26)}x{chr(97 + k % 26)}><p>t</p></div>" for k in range(3000)) + "</body>" for j in (1, 3, 5)]
    assert hx.skeleton(wide)


def tree(rng, depth=3):
    return hx.Slot(rng.choice("abc"), [tree(rng, depth - 1) for _ in range(rng.randrange(0, 4))] if depth else [])


def largest(a, b):
    """Simple tree matching by trying every order-preserving choice of children."""
    if a.key != b.key:
        return 0
    best = 0
    for n in range(min(len(a.children), len(b.children)) + 1):
        for x in itertools.combinations(a.children, n):
            for y in itertools.combinations(b.children, n):
                best = max(best, sum(largest(p, q) for p, q in zip(x, y, strict=True)))
    return best + 1


def test_simple_tree_matching():
    rng = random.Random(6)
    for _ in range(200):
        a, b = tree(rng), tree(rng)
        size, pairs = hx.match(a, b)
        assert size == largest(a, b) == len(pairs)


def test_very_long_and_broken_pages():
    assert hx.main_text("<article><p>" + "word " * 100000 + "<p>end") == "word " * 99999 + "word\nend"
    assert hx.main_text("<article><p>a</p></div></article><p>b") == "a"
    assert hx.main_text("<article>one<script>x") == "one"
    assert hx.main_text("<article>one <b>two</b><!-- x") == "one two"
    assert hx.main_text("<article>one <b") == "one"
    assert hx.main_text("<div>" * 400 + "deep" + "</div>" * 400) == "deep"


def test_a_template_on_few_pages_of_a_layout(spark):
    rng = random.Random(10)
    pages, want = [], {}
    for k in range(400):
        b = blocks(rng, rng.randrange(2, 6))
        extra = "<center>Tell your friends</center>" if k % 50 == 7 else ""
        pages.append("<body><div class=a1><p>The Daily Site</p></div><div class=c1>" + "".join(f"<p>{html.escape(x)}</p>" for x in b) + extra + "</div></body>")
        want[k] = "\n".join(b)
    assert extracted(spark, pages) == want


def test_copies_of_a_page_leave_the_others_their_wrapper(spark):
    rng = random.Random(11)
    texts = [blocks(rng, 4) for _ in range(12)]
    pages = [f"<body><div class=a1>The Daily Site</div><div class=c1>{''.join(f'<p>{html.escape(x)}</p>' for x in b)}</div></body>" for b in texts]
    rows = [(40 * k + n, f"https://h.example.com/{k}", p) for k, p in enumerate(pages) for n in range(40)]
    got = {r["page_id"]: r["text"] for r in hx.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {40 * k + n: "\n".join(b) for k, b in enumerate(texts) for n in range(40)}


def test_elements_with_names_of_their_own(spark):
    """Headings and wrapping elements with an id from their page's title: the tree has none of them, their text counts."""
    rng = random.Random(12)
    pages, want = [], {}
    for k in range(60):
        b = blocks(rng, 5)
        name = "".join(rng.choices("abcdefghij", k=12))
        pages.append(
            f"<body><div class=a1><p>The Daily Site</p><p>{rng.random()}</p></div><div class=c0><h1 id={name}x>{html.escape(b[0])}</h1><div class=c1><div class=c2 id={name}>"
            f"<h2 id={name}y>{html.escape(b[1])}</h2>{''.join(f'<p>{html.escape(x)}</p>' for x in b[2:])}</div></div></div><div class=e1>All rights reserved</div></body>"
        )
        want[k] = "\n".join(b)
    assert extracted(spark, pages) == want
    trees = [hx.Slot.load(hx.json.loads(hx.skeleton(pages[:n]))) for n in (10, 60)]
    assert [len(list(t.all())) for t in trees] == [7, 7]


def test_merged_trees_hold_every_page_and_stay_as_they_are():
    rng = random.Random(13)
    for _ in range(60):
        shapes = [hx._json(hx.Slot("a", tree(rng, 2).children)) for _ in range(5)]
        parts = [hx.merged((0, s) for s in some)[0] for some in (shapes[:2], shapes[2:])]
        whole = hx.Slot.build(hx.json.loads(hx.merged((0, p) for p in parts)[0]))
        before = hx._json(whole)
        for s in shapes:
            page = hx.Slot.build(hx.json.loads(s))
            assert hx.match(whole, page)[0] == sum(1 for _ in page.all())
            assert hx.holds(whole, s) and not hx.strays(hx.match(whole, page)[1])
            hx.absorb(whole, page)
        assert hx._json(whole) == before


def test_paths_on_too_few_pages_are_cut():
    shapes = [hx.shape(p) for p in ("<p>a</p><div><p>b</p></div>", "<div><p>c</p><ul></ul></div>", "<div class=x><p>d</p></div>")]
    on = [hx.paths(s) for s in shapes]
    assert [len(p) for p in on] == [4, 4, 3]
    assert hx.pruned(shapes[1], frozenset(on[0] & on[1])) == '["#root",[["div",[["p",[]]]]]]'
    assert hx.pruned(shapes[2], frozenset(on[0] & on[1])) == '["#root",[]]'
    assert hx.pruned(shapes[0], frozenset()) is None


def test_wrappers_of_varied_pages_hold_all_of_them(spark, monkeypatch):
    rng = random.Random(14)
    pages, want = [], {}
    for k in range(120):
        b = blocks(rng, rng.randrange(3, 9))
        body = "".join(rng.choice(("<p>{}</p>", "<pre>{}</pre>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>")).format(html.escape(x)) for x in b)
        pages.append(f"<body><div class=a1><p>The Daily Site</p></div><div class=c1>{body}<center>Tell your friends</center></div></body>")
        want[k] = "\n".join(b)
    table = spark.createDataFrame([(k, f"https://h{k % 2}.example.com/{k}", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    for bunch, rounds, size in ((1000, 4, hx.BROADCAST_BYTES), (5, 50, hx.BROADCAST_BYTES), (5, 2, 0)):
        monkeypatch.setattr(hx, "BUNCH", bunch)
        monkeypatch.setattr(hx, "ROUNDS", rounds)
        monkeypatch.setattr(hx, "BROADCAST_BYTES", size)
        found = {r["host"]: hx.Slot.load(hx.json.loads(r["tree"])) for r in hx.wrappers(table).collect()}
        assert len(found) == 2
        on = [hx.Counter(x for p in pages[h::2] for x in hx.paths(hx.shape(p))) for h in (0, 1)]
        for k, p in enumerate(pages):
            assert hx.holds(found[f"h{k % 2}.example.com"], hx.pruned(hx.shape(p), frozenset(x for x, n in on[k % 2].items() if n >= hx.LEAST_PAGES)))
        assert {r["page_id"]: r["text"] for r in hx.extract(table).collect()} == want


def test_wrappers_beyond_the_bytes_held_are_read_anew(monkeypatch):
    monkeypatch.setattr(hx, "KNOWN_BYTES", 10)
    reads = []
    known = hx.Known(lambda x: reads.append(x) or x.upper())
    assert [known.get(k, t) for k, t in ((1, "abcd"), (2, "efgh"), (1, "abcd"), (3, "ij"), (4, "kl" * 9), (4, "kl" * 9), (1, "abcd"))] == ["ABCD", "EFGH", "ABCD", "IJ", "KL" * 9, "KL" * 9, "ABCD"]
    assert reads == ["abcd", "efgh", "ij", "kl" * 9, "abcd"]
