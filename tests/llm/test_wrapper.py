"""Reading, alignment, wrappers, and whole pages."""

from __future__ import annotations

import html
import random
import re
import time
import tracemalloc

from shelfcast.llm import wrapper as w


def text(page, *others):
    own = w.Page(page)
    return w.Wrapper([own, *map(w.Page, others)]).text(own)


def test_left_out_parts_and_entities():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></ul></nav><div class="ad">Buy</div>
    <div class="cookie-notice"><p>We use</p></div><aside>Side</aside><!-- <p>no</p> -->
    <article><h1>Title &amp; more</h1><p><b>First &lt;one&gt;<br><p>Second
      line &quot;q&quot; &#233;&hellip; a < b</p><form><p>Mail <input> <button>Go</button></p></form>
    <ul><li>One<li>Two</ul><section id="comments"><p>Reader says</p></section></article>
    <footer>&copy; x</footer></body></html>"""
    assert text(page) == "Title & more\nFirst <one>\nSecond line \"q\" é… a < b\nOne\nTwo"


def test_cut_off_pages():
    assert text("<body><article><p>Some text &amp") == "Some text &"
    assert text('<body><article><p>Some text</p><a href="/x') == "Some text"
    assert text("<article><p>a</p><nav><ul><li>m</article>") == "a"
    assert text("<article><p>a longer text</p><div class='ad'>b</article><p>after<p>that") == "a longer text\nafter\nthat"
    assert text("") == text("<html></html>") == ""
    assert text("no tags at all") == "no tags at all"
    assert text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    long = "word " * 100_000
    assert text(f"<article>{'<p>p</p>' * 5000}<p>{long}</p></article>") == "p\n" * 5000 + long.strip()


def test_simple_tree_matching():
    a = w.Page("<div><h1>a</h1><p>x</p><p>y</p><ul><li>1</ul></div><div class='k'>q</div>").tree
    b = w.Page("<div><p>x</p><table><tr><td>t</table><ul><li>1<li>2</ul></div><div class='k'>r</div>").tree
    score, pairs = w.align(a, b)
    # body, div, p, ul, li, div.k
    assert score == len(pairs) == 6 and all(x.label == y.label for x, y in pairs)
    assert w.align(a, a)[0] == a.weight


def plain(title, body, extra=""):
    return (f"<body><div class='top'>My site</div><div class='wrap'><div class='left'><p>Contact us</p></div>"
            f"<div class='text'><h2>{title}</h2>{''.join(f'<p>{p}</p>' for p in body)}</div></div>"
            f"<div class='end'>All rights</div>{extra}</body>")


def test_template_without_article_elements():
    pages = [plain(f"Title {i}", [f"Paragraph {i} {j} with some words of its own" for j in range(1 + i % 4)]) for i in range(8)]
    for i, p in enumerate(pages):
        want = "\n".join([f"Title {i}"] + [f"Paragraph {i} {j} with some words of its own" for j in range(1 + i % 4)])
        assert text(p, *pages) == want


def test_copies_on_a_host_keep_their_article():
    page = "<body><nav>m</nav><article><h1>T</h1><p>Same text</p><p>{}</p></article></body>"
    pages = [page.format(i) for i in range(9)]
    assert text(pages[4], *pages) == "T\nSame text\n4"


def test_given_pages(spark):
    path = "/root/testdata/sf0.01/pages.parquet"
    rows = {r.page_id: r for r in spark.read.parquet(path).collect()}
    got = {r.page_id: r for r in w.op9_wrapper_induction(spark, "/root/testdata/sf0.01").collect()}
    assert got.keys() == rows.keys()
    for i, r in rows.items():
        # these pages' articles hold headings and paragraphs only
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)
        cut = re.sub(r"<[^>]*$", "", inner[1]) if inner else ""
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", cut)]
        want = "\n".join(b for b in blocks if b)
        assert (got[i].text, got[i].n_chars, got[i].url) == (want, len(want), r.url)


def test_odd_rows(spark):
    rows = [(1, "http://a.com/1", None, "x"), (2, None, "<p>two", "x"), (2, None, "<p>two", "x"), (None, "not a url", "<p>n", "x")]
    rows += [(10 + i, "https://u@HOT.com:80/p", f"<article><p>hot {i}</article>", "x") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = w.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id or 0, r.text) for r in out.collect()))
    assert got == sorted([(1, ""), (2, "two"), (2, "two"), (0, "n")] + [(10 + i, f"hot {i}") for i in range(400)])
    assert w.extract(df.limit(0)).count() == 0


def test_marks_are_never_on_what_holds_the_article():
    inner = "<nav>m</nav><{0}><h1>T</h1><p>A text of some words</p><div class='ad'>Buy</div></{0}><div class='sidebar'>side</div>"
    for around in ("<body class='single no-sidebar'>{}</body>", "<body><div id='page' class='with-sidebar'>{}</div></body>",
                   "<body><div class='ad-free'>{}</div></body>", "<body><form action='/'>{}</form></body>",
                   "<body><div class='sidebar right'><form>{}</form></div></body>", "<body class='login ad'><div id='comments'>{}</div></body>",
                   "<html class='cookie'><body>{}</body></html>"):
        for tag in ("article", "main", "article class='post no-comments ad'"):
            page = around.format(inner.format(tag).replace(f"</{tag}>", f"</{tag.split()[0]}>"))
            assert text(page) == "T\nA text of some words", page
    plain_page = "<form><nav>m</nav><div class='text'><p>A text of some words</p></div><div class='ad'>Buy</div></form>"
    assert text(plain_page) == "A text of some words"
    # inside an article; comments and related posts stay dropped
    assert text("<article><div class='promo body'><p>A text of some words</p></div><p>end</p></article>") == "A text of some words\nend"
    assert text("<article><p>Post</p></article><section id='comments'><article><p>A much longer comment</p></article></section>") == "Post"
    assert text("<p>One text of words <span class='ad'>Buy <span>now</span> it</span> two") == "One text of words\ntwo"


def test_hosts_pages_decide_on_marks_that_align():
    page = "<body><nav>m</nav><div class='ad'>Buy {}</div><article><p>Text {}</p></article></body>"
    cut = "<body><nav>m</nav><div class='ad'>Buy"
    pages = [page.format(i, i) for i in range(5)]
    assert text(cut, *pages) == ""


def test_what_varies_or_does_not_align_is_kept():
    page = ("<body><div class='top'>My site</div><nav>m</nav><h1>Title {0}</h1><div class='lead'>Lead {0}</div>"
            "<article class='post'><p>A long text of article {0} with words</p></article>{1}<div class='end'>All rights</div></body>")
    pages = [page.format(i, "") for i in range(6)]
    extra = "<article class='post sticky'><p>Sticky</p></article><div class='odd'><p>Odd part</p><article class='post'>More</article></div>"
    own = page.format(9, extra)
    assert text(own, *pages) == "Title 9\nLead 9\nA long text of article 9 with words\nSticky\nOdd part\nMore"
    assert text(pages[2], *pages, own) == "Title 2\nLead 2\nA long text of article 2 with words"


def test_one_wrapper_a_host_from_different_pages(spark):
    def page(i):
        return f"<body><div class='top'>My site</div><div class='text'><p>Text {i} of its own</p></div><p class='end'>Rights</p></body>"

    copies = [(i, "http://a.com/", page(0)) for i in range(60)]
    rows = copies + [(100 + i, "http://a.com/", page(i)) for i in range(1, 30)]
    # the same page with other markup, and a null
    rows += [(200, "http://a.com/", page(3).replace("<p>", "<article>").replace("</p></div>", "</article></div>")), (300, "http://b.com/", None)]
    # a hot host with the same pages, cut into pieces
    hot = [(1000 + i, "http://a.com/", page(i % 29)) for i in range(600)]
    schema = "page_id long, url string, html string"

    def got(rows, parts):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            return {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows, schema)).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    small, large, many = got(rows, 2), got(rows + hot, 2), got(rows + hot, 7)
    assert small[5] == "Text 0 of its own" and small[110] == "Text 10 of its own" and small[200] == "Text 3 of its own"
    assert small[300] == "" and len(small) == len(rows) and len(large) == len(rows) + len(hot)
    assert {k: large[k] for k in small} == small and many == large
    assert all(large[1000 + i] == f"Text {i % 29} of its own" for i in range(600))


def test_a_lone_page_keeps_what_is_not_marked():
    page = ("<body><nav>m</nav><h1>Title</h1><div class='lead'>Lead</div><article><p>A long text of an article</p></article>"
            "<p>Last words</p><div class='ad'>Buy</div></body>")
    assert text(page) == "Title\nLead\nA long text of an article\nLast words"


def test_alignment_finds_what_no_list_names():
    """Boilerplate without a telling element, role or class, outside of the article
    and inside of it: the lists alone keep all of it."""
    def page(i):
        own = " ".join(f"word{i}x{k}" for k in range(12))
        return (f"<body><div class='strip'>All the news</div><article><h1>Title {i}</h1><p>{own}</p><p>Thanks for reading our paper</p>"
                f"<p>{own} again</p></article><p>Call the desk</p><div class='rest'><p>Follow us</p><p>Number {i}</p></div></body>")

    pages = [page(i) for i in range(6)]
    own = " ".join(f"word2x{k}" for k in range(12))
    assert text(pages[2], *pages) == f"Title 2\n{own}\n{own} again\nNumber 2"
    alone = text(pages[2])
    assert all(x in alone for x in ("All the news", "Thanks for reading our paper", "Call the desk", "Follow us"))


def size(a, b):
    """Simple tree matching as it is defined."""
    if a.label != b.label:
        return 0
    score = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, x in enumerate(a.kids, 1):
        for j, y in enumerate(b.kids, 1):
            score[i][j] = max(score[i - 1][j], score[i][j - 1], score[i - 1][j - 1] + size(x, y) if x.label == y.label else 0)
    return 1 + score[-1][-1]


def made(rng, depth=0):
    kids = "".join(made(rng, depth + 1) for _ in range(rng.randrange(0, 6 - depth)))
    tag = rng.choice(["div", "section", "ul", "dl"])
    return f"<{tag} class='{rng.choice('abc')}'>{kids}t</{tag}>"


def test_matching_is_the_largest(monkeypatch):
    for cells in (w.CELLS, 1):                               # with tables, and halved all the way
        monkeypatch.setattr(w, "CELLS", cells)
        rng = random.Random(4)
        for _ in range(40):
            a, b = w.Page(made(rng)).tree, w.Page(made(rng)).tree
            found, pairs = w.align(a, b)
            assert found == len(pairs) == size(a, b) == w.Matching().size(a, b)
            order = {id(n): i for t in (a, b) for i, n in enumerate(t.walk())}
            places = [(order[id(x)], order[id(y)]) for x, y in pairs]
            assert places == sorted(places) and len({x for x, _ in places}) == len({y for _, y in places}) == len(places)
            assert all(x.label == y.label for x, y in pairs)


def test_wide_pages_align_in_little_time_and_space():
    def page(n, odd):
        rows = "".join(f"<dt class='{'k' if i % odd else 'q'}'>a{i}</dt><dd>b{i}</dd>" for i in range(n))
        return w.Page(f"<body><div>top</div><dl>{rows}</dl></body>")

    a, b = page(2500, 7), page(2400, 11)                     # 5,000 siblings that alternate and differ
    tracemalloc.start()
    began = time.monotonic()
    found, pairs = w.align(a.tree, b.tree)
    assert time.monotonic() - began < 30 and tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert found == len(pairs) > 4000
