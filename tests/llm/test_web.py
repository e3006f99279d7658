"""URL verdicts and main text."""

import random
import time

import duckdb
import pytest

from tallyhouse.llm import htmlextract, urlfilter
from tallyhouse.llm.queries import SQL

PAGES = "page_id long, url string, html string, host string, rule string, text string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "r", "t") for i, u, h in rows], PAGES)


def verdicts(spark, rows, **more):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judged(pages(spark, rows), **more).collect()}


CASES = [
    ("http://A.Example.ORG/es/1?q=/en/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12#x", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/ES/1", "example.org", "/ES/1", "org/", "allow"),
    ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"),
    ("http://x.com/de", "x.com", "/de", None, "allow"),
    ("http://com/de/", "com", "/de/", "com/de/", "block"),
    ("http://example.org", "example.org", "", None, "allow"),
    ("http://example.org?x=/es/", "example.org", "", None, "allow"),
    ("example.org/es/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://example.org/es/", "example.org", "/es/", "example.org/es/", "block"),
    ("http://u.net/a://b.com/de/", "u.net", "/a://b.com/de/", None, "allow"),
    ("http://example.org/es/\nline", "example.org", "/es/\nline", "example.org/es/", "block"),
]


def test_rules(spark):
    got = verdicts(spark, [(i, case[0], None) for i, case in enumerate(CASES)])
    assert got == {i: case[1:] for i, case in enumerate(CASES)}


def canonical(url):
    return f'<html><head><LINK href="{url}" rel="canonical"></head></html>'


def test_blocks_spread_to_aliases_but_not_over_an_allow(spark):
    rows = [
        (1, "http://n.net/a", canonical("http://x.com/de/1")),
        (2, "http://n.net/b#top", '<meta http-equiv="refresh" content="0; url=http://n.net/a">'),
        (3, "http://n.net/b", ""),
        (4, "http://good.org/a", canonical("http://n.net/b")),
        (5, "http://m.net/a", canonical("http://x.com/fr/1")),
        (6, "http://m.net/b", '<link rel="stylesheet" href="http://x.com/de/1">'),
        (7, "http://n.net/c?x=1&y=2", ""),
        (8, "http://n.net/d", canonical("http://n.net/c?x=1&amp;y=2")),
        (9, "http://n.net/c?x=1&y=2", canonical("http://x.com/de/9")),
        (10, None, canonical("http://x.com/de/9")),
        (11, "http://n.net/e", canonical("/relative")),
    ]
    want = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block", 10: "allow", 11: "allow"}
    assert {i: v[3] for i, v in verdicts(spark, rows).items()} == want
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert {r[0]: r[4] for r in con.execute(SQL["op6_urls"]).fetchall()} == want


def test_redirects_from_a_crawl(spark):
    redirects = spark.createDataFrame([("http://n.net/z", "http://n.net/y"), ("http://n.net/y", "http://x.com/de/"), (None, "http://n.net/q")], "url string, target string")
    rows = [(1, "http://n.net/z", None), (2, "http://n.net/q", None), (2, "http://n.net/q", None)]
    table = pages(spark, rows)
    assert sorted((r.page_id, r.verdict) for r in urlfilter.judged(table, redirects).collect()) == [(1, "block"), (2, "allow"), (2, "allow")]


TARGETS = [
    ("http://x.com/a", "/de/1"),
    ("http://x.com/fr/sub/a?q=1", "../../de/1"),
    ("http://x.com/de/a", "b"),
    ("http://n.net/a", "//X.com/de/1"),
    ("HTTP://N.net/b", "http://X.COM/de/2"),
    ("http://x.com", "de/1"),
]


def test_relative_targets_are_resolved(spark):
    rows = [(i, u, canonical(t)) for i, (u, t) in enumerate(TARGETS)]
    rows += [
        (10, "http://y.com/a", '<meta http-equiv="refresh" content="0; url=./x/../de/1">'),
        (11, "http://n.net/c", '<base href="//x.com/de/"><link rel="canonical" href="1">'),
        (12, "http://N.NET/d", ""),
        (13, "https://n.net/e", canonical("http://n.net/d")),
        (14, "http://n.net/d", canonical("http://x.com/de/3")),
        (20, "http://n.net/f", canonical("/g?u=http://x.com/de/1")),
        (21, "http://x.com/a/b", canonical("de/1")),
        (22, "http://n.net/h", canonical("mailto:a@x.com")),
        (23, "x.com/a", canonical("/de/1")),
        (24, "http://n.net/i", canonical("#top")),
        (25, "http://n.net/D", ""),
    ]
    got = {i: v[3] for i, v in verdicts(spark, rows).items()}
    assert got == {i: "block" if i < 20 else "allow" for i, *_ in rows} | {1: "allow"}  # its own rule allows com/fr/
    redirects = spark.createDataFrame([("http://x.com/a/b", "/de/1")], "url string, target string")
    assert verdicts(spark, rows, redirects=redirects)[21][3] == "block"


# RFC 3986, 5.4
REFERENCES = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "g#s": "http://a/b/c/g#s", ";x": "http://a/b/c/;x", "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/",
    "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g..": "http://a/b/c/g..", "./g/.": "http://a/b/c/g/", "g/../h": "http://a/b/c/h", "g?y/../x": "http://a/b/c/g?y/../x",
}


def test_references_resolve_as_in_the_standard(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(t, "http://a/b/c/d;p?q") for t in REFERENCES], "target string, base string")
    assert {r[0]: r[1] for r in table.select("target", urlfilter.resolved(F.col("target"), F.col("base"))).collect()} == REFERENCES


def test_no_pages(spark):
    assert verdicts(spark, []) == {}


@pytest.fixture(scope="module")
def field():
    return htmlextract.train(htmlextract.training_pages())


LAYOUTS = [
    (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>"
        '<div class="ad">Buy this now.</div><article><h1>The  title</h1><p><b>Bold &amp; first.<br><p>Second &lt;tag&gt; here,\n\tgoes on.</p><p>Two.</p></article>'
        "<footer>&copy; site &middot; All rights.</footer></body></html>",
        "The title\nBold & first.\nSecond <tag> here, goes on.\nTwo.",
    ),
    (
        '<body><header class="site-header"><div>Site name</div><nav><a href="/">Home</a> <a href="/x">More</a></nav></header><div class="cookie-notice"><p>We use cookies to make '
        'this site better for you.</p><button>OK</button></div><main><article class="post"><h1>Headline of it</h1><p>A first paragraph of some length, with a <a href="/l">link</a> in it.</p>'
        '<aside class="related"><ul><li><a href="/r">Read this</a></li></ul></aside><p>The last paragraph follows here.</p></article><section class="comments"><h3>Comments</h3>'
        '<div class="comment"><p>I do not agree with anything said here at all.</p></div></section></main><aside class="sidebar"><p>Popular now</p></aside>'
        '<form class="search"><label>Search</label><input><button>Go</button></form><footer><p>Imprint</p></footer></body>',
        "Headline of it\nA first paragraph of some length, with a link in it.\nThe last paragraph follows here.",
    ),
]


@pytest.mark.parametrize("page, text", LAYOUTS)
def test_layouts(field, page, text):
    assert "\n".join(field.main_blocks(page, field.scorer())) == text


def test_unseen_composed_pages(field):
    score, right, blocks = field.scorer(), 0, 0
    for page, labels in htmlextract.training_pages(seed=123)[:150]:
        texts = [b[2] for b in htmlextract.leaf_blocks(page, htmlextract.element_features, ())]
        chosen = field.main_blocks(page, score)
        wanted = [t for t, main in zip(texts, labels, strict=True) if main]
        blocks += len(texts)
        right += len(texts) - len(set(chosen) ^ set(wanted))
    assert right >= 0.97 * blocks


def test_viterbi_finds_the_best_labelling(field):
    import itertools

    for page, _ in htmlextract.training_pages(seed=5)[:60]:
        blocks = htmlextract.leaf_blocks(page, field.scorer(), 0.0)
        if not 1 <= len(blocks) <= 11:
            continue

        def worth(labels):
            total = field.first * labels[0]
            for i, label in enumerate(labels):
                path, tag, text, linked = blocks[i]
                total += label * (path + sum(field.features.get(f, 0.0) for f in htmlextract.text_features(tag, text, linked)))
                total += field.steps[labels[i - 1], label] if i else 0.0
            return total

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=worth)
        chosen = field.main_blocks(page, field.scorer())
        assert worth(best) == pytest.approx(worth([int(b[2] in chosen) for b in blocks])) or chosen == [b[2] for b, x in zip(blocks, best, strict=True) if x]


def test_odd_pages(spark):
    deep = "<article>" + "<div>" * 3000 + "<p>deep text is here.</p>" + "</div>" * 3000 + "</article>"
    long = "<article><h1>Title</h1>" + "<p>One more sentence of it.</p>" * 20_000 + "</article>"
    rows = [
        (1, "u", None), (2, None, ""), (3, "u", "   "), (4, "u", "<article><p>left open &amp; cut"), (5, "u", "<!-- never closed <p>x</p>"), (6, "u", "<script>never closed <p>x</p>"),
        (7, "u", deep), (8, "u", long), (9, "u", "<article><p a=\"x>y\" b='>'>quoted ends</p><p title=\"open>cut off here.</p></article>"), (None, "u", "<article><p>no id here.</p></article>"),
        (4, "u", "<article><p>left open &amp; cut"),
    ]
    got = [(r.page_id, r.text, r.n_chars) for r in htmlextract.extracted(pages(spark, rows)).collect()]
    texts = dict((i, t) for i, t, _ in got)
    assert len(got) == len(rows) and all(n == len(t) for _, t, n in got)
    assert [texts[i] for i in (1, 2, 3, 5, 6)] == [""] * 5
    assert texts[4] == "left open & cut" and texts[7] == "deep text is here." and texts[None] == "no id here."
    assert texts[8].count("\n") == 20_000 and texts[9].startswith("quoted ends")
    assert htmlextract.extracted(pages(spark, [])).collect() == []


def test_test_pages_give_their_article(spark):
    import html as references
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in htmlextract.extracted(rows).collect()}
    for row in rows.collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = (" ".join(references.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[row.page_id] == "\n".join(b for b in blocks if b)


def test_random_markup_never_fails(field):
    draw = random.Random(2)
    bits = ["<", ">", "</", "p", "div", " class='a", '"', "'", "&", "&#x", "&lt", "<!--", "-->", "<script", "</script>", "text ", "\x00", "<a href=x>", "/>", "=", "<li>", "</ul>"]
    for _ in range(3000):
        field.main_blocks("".join(draw.choices(bits, k=draw.randint(0, 30))), field.scorer())


@pytest.mark.parametrize(
    "unit",
    ["<a ", '<a href="', "<a '>'", "<", "<!", "</script ", "<p", "<a\"'", "&", "<li><p>", "<script ", "<div class='"],
)
def test_broken_pages_take_time_in_proportion(unit):
    for page in (unit * (1_000_000 // len(unit)), "<script>" + unit * (1_000_000 // len(unit))):
        begun = time.process_time()
        htmlextract.leaf_blocks(page, lambda tag, attributes: (0.0, None), 0.0)
        assert time.process_time() - begun < 4


def test_stray_closing_tags_in_deep_nesting():
    page = "<div>" * 80_000 + "</p>" * 120_000 + "text"
    begun = time.process_time()
    assert [b[2] for b in htmlextract.leaf_blocks(page, lambda tag, attributes: (0.0, None), 0.0)] == ["text"]
    assert time.process_time() - begun < 2
