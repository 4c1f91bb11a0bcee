import numpy as np
import pytest

from lutrin.llm import boilerplate
from lutrin.llm.boilerplate import main_text, suffix_order
from lutrin.llm.html_blocks import ARTICLE, FRAME, OPEN, blocks


def pages_of(spark, pages):
    return spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS row", "'x' AS host", "'x' AS text", "1 AS parts")


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", []),
        ("plain &amp; text\n here", [(OPEN, "plain & text here")]),
        ("<p>a<p>b <b>c</b>d<br>e", [(OPEN, "a"), (OPEN, "b cd e")]),
        ("<nav><a>m</a></nav><article><h1>T</h1><p>x&nbsp;y</article><footer>f", [(FRAME, "m"), (ARTICLE, "T"), (ARTICLE, "x y"), (FRAME, "f")]),
        ("<article><p>a</p><aside>b</aside><div class='ad'>c</div><p>d</p></article>", [(ARTICLE, "a"), (FRAME, "b"), (FRAME, "c"), (ARTICLE, "d")]),
        ("<article>a<section id=comments><article>r</article></section>b</article>z", [(ARTICLE, "a"), (FRAME, "r"), (ARTICLE, "b"), (FRAME, "z")]),
        ("<article>a<script>x('</p>')</script>b<style>p{}</style><!-- <p>c --> d</article>", [(ARTICLE, "a b d")]),
        ("<nav>m<article><p>a</article>", [(FRAME, "m"), (ARTICLE, "a")]),
        ("<article>a</div>b</article>", [(ARTICLE, "a"), (ARTICLE, "b")]),
        ('<div itemprop="articleBody"><p>a</div><p>b', [(ARTICLE, "a"), (FRAME, "b")]),
        ('<article><p title="a > b">c &lt;d&gt; &#8364; &notanentity;', [(ARTICLE, "c <d> € ¬anentity;")]),
        ("<article>a<form><input><p>b</form><header>h</header>c <script>never closed", [(ARTICLE, "a"), (FRAME, "b"), (FRAME, "h"), (ARTICLE, "c")]),
        ("<html><head><title>t</title></head><body class='sidebar'><p>a", [(FRAME, "t"), (OPEN, "a")]),
        ("a < b and <3 c", [(OPEN, "a < b and <3 c")]),
    ],
)
def test_blocks(page, expected):
    assert blocks(page) == expected


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_pages_without_article_lose_what_their_host_repeats(spark):
    menu, legal = words("menu", 12), words("legal", 20)

    def page(i, host, extra=""):
        body = f"<div>{menu}</div><div><p>{words(f'own{i}x', 15)}</p><p>short {i}</p></div><div>{legal}{extra}</div>"
        return (i, f"https://{host}/p/{i}", f"<html><body>{body}</body></html>")

    rows = [page(1, "a.example.com"), page(2, "A.example.com"), page(3, "b.example.com"), page(4, "a.example.com", " tail4 here")]
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows)).collect()}
    own = lambda i: f"{words(f'own{i}x', 15)}\nshort {i}"
    assert got[1] == own(1) and got[2] == own(2)
    assert got[3] == "\n".join([menu, own(3), legal])  # the only page of its host
    assert got[4] == own(4) + "\ntail4 here"


def test_frames_of_article_pages_count_as_evidence(spark):
    menu = words("menu", 12)
    rows = [
        (1, "https://h.example/1", f"<nav>{menu}</nav><article><p>{words('text', 30)}</p></article>"),
        (2, "https://h.example/2", f"<div>{menu}</div><p>{words('other', 30)}</p>"),
        (3, "https://h.example/3", f"<article><p>{words('text', 30)}</p></article>"),  # a copied article stays
    ]
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows)).collect()}
    assert got == {1: words("text", 30), 2: words("other", 30), 3: words("text", 30)}


def test_articles_keep_what_their_host_repeats_and_take_no_unique_frames(spark):
    shared = words("shared", 20)
    rows = [(i, f"https://h.example/{i}", f"<div>{words(f'once{i}x', 20)}</div><article><p>{shared}</p><p>own {i}</p></article>") for i in range(6)]
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows)).collect()}
    assert got == {i: f"{shared}\nown {i}" for i in range(6)}


def test_copies_and_quotes_are_no_boilerplate(spark):
    menu, quote = words("menu", 12), words("quote", 15)

    def page(i, body, top=f"<div>{menu}</div>"):
        return (i, f"https://h.example/{i}", f"<body>{top}{body}</body>")

    own = lambda i: f"<p>{words(f'own{i}x', 30)}</p>"
    rows = [page(i, own(0)) for i in range(40)]  # copies of one page, most of the host
    rows += [page(40 + i, own(40 + i)) for i in range(6)]
    rows += [page(46, own(1), ""), page(47, own(1))]  # a print view
    rows += [page(48 + i, f"<p>{quote}</p>" + own(48 + i)) for i in range(2)]
    rows += [(i, f"https://copies.example/{i}", f"<p>{words('all', 20)}</p>") for i in (60, 61, 62, 63)]
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows).repartition(5)).collect()}
    text = lambda i: words(f"own{i}x", 30)
    assert all(got[i] == text(0) for i in range(40))
    assert all(got[40 + i] == text(40 + i) for i in range(6))
    assert got[46] == got[47] == text(1)
    assert all(got[i] == f"{quote}\n{text(i)}" for i in (48, 49))
    assert all(got[i] == words("all", 20) for i in (60, 61, 62, 63))


def test_pages_are_counted_once_over_all_tasks(spark):
    """The decision equals brute force over the distinct pages of every host."""
    rng = np.random.default_rng(3)
    parts = [words(f"part{k}x", 9) for k in range(12)]
    rows = []
    for i in range(120):
        own = [parts[k] for k in sorted(rng.choice(12, 3, replace=False, p=np.arange(1, 13) / 78))]
        rows.append((i, f"https://h{i % 3}.example/", "".join(f"<p>{x}</p>" for x in [*own, f"own {rng.integers(30)}"])))
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows).repartition(7)).collect()}
    seen, tokens = {}, {i: (url, [w for _, t in blocks(html) for w in t.split()]) for i, url, html in rows}
    run = boilerplate.RUN
    for url, own in tokens.values():
        for k in range(len(own) - run + 1):
            seen.setdefault((url, *own[k : k + run]), set()).add(tuple(own))
    for i, url, html in rows:
        own, gone = tokens[i][1], set()
        pages = len({tuple(t) for u, t in tokens.values() if u == url})
        for k in range(len(own) - run + 1):
            n = len(seen[(url, *own[k : k + run])])
            if n >= boilerplate.LEAST_PAGES and n >= boilerplate.SHARE * pages:
                gone |= set(range(k, k + run))
        assert got[i].split() == [w for k, w in enumerate(own) if k not in gone]


def test_a_substring_within_one_page_is_no_boilerplate(spark):
    twice = words("w", 20)
    rows = [(1, "https://h.example/1", f"<p>{twice}</p><p>{twice}</p>"), (2, "https://h.example/2", "<p>short</p>")]
    got = {r.page_id: r.text for r in main_text(pages_of(spark, rows)).collect()}
    assert got[1] == f"{twice}\n{twice}"


def test_nulls_ids_and_empty_table(spark):
    rows = [(1, None, "<article>a</article>"), (None, "https://x/", None), (1, "x", ""), (2, "::", "<p> </p>")]
    got = main_text(pages_of(spark, rows)).collect()
    assert sorted((r.page_id or -1, r.text, r.n_chars) for r in got) == [(-1, "", 0), (1, "", 0), (1, "a", 1), (2, "", 0)]
    assert main_text(pages_of(spark, rows).where("false")).count() == 0


def test_long_page(spark):
    text = "\n".join(words(f"p{i}x", 50) for i in range(400))
    html = "<article>" + "".join(f"<p>{line}</p>" for line in text.split("\n")) + "</article>"
    assert main_text(pages_of(spark, [(1, "https://x/", html)])).first().text == text


def test_suffix_order_is_that_of_sorted_prefixes():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 3, 300).astype(np.uint64)
    page = np.repeat([5, 6, 9], 100)
    order, rank = suffix_order(ids, page)
    prefixes = [tuple(ids[i : i + boilerplate.RUN]) if i % 100 <= 100 - boilerplate.RUN else None for i in range(300)]
    whole = [i for i in order if rank[i] >= 0]
    assert [prefixes[i] for i in whole] == sorted(p for p in prefixes if p)
    for i in range(300):
        assert (rank[i] < 0) == (prefixes[i] is None)
    assert len({(prefixes[i], rank[i]) for i in whole}) == len({prefixes[i] for i in whole})
