"""Main text of pages with known articles; exact marginals on small trees."""
import html as H
import itertools
import re

import numpy as np
import pytest

from ordwise.llm import extraction as X
from ordwise.llm.queries import op1_extraction


def article_text(page):
    """The article of a generated page: its blocks between tags, decoded and trimmed."""
    a = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    a = re.sub(r"<(/?)(p|h1|article)\b[^>]*>", "\n", a.replace("\n", " "))
    a = re.sub(r"<[^>]+>", "", re.sub(r"<br>", " ", a))
    return "\n".join(x for x in (re.sub(r"\s+", " ", H.unescape(p)).strip() for p in a.split("\n")) if x)


def test_query_equals_known_articles(spark, small):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = op1_extraction(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = article_text(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


@pytest.fixture(scope="module")
def fitted():
    import duckdb
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    return X.potentials_from(X.count_labelled([X.parse(r[0]) for r in rows]))


STORY = "<p>A long paragraph of the story, which goes on for some time.</p><p>Another one; with a bit more text.</p>"
WANT = "A long paragraph of the story, which goes on for some time.\nAnother one; with a bit more text."
AROUND = {
    "menu": '<div id="menu"><a href=x>Home</a> <a href=y>News</a></div>',
    "nav": "<nav><ul><li><a href=x>Home</a><li><a href=y>More</a></ul></nav>",
    "header": "<header><h1>The Site</h1><p>Its motto is a sentence.</p></header>",
    "footer": "<footer>&copy; 2020 &middot; All rights reserved.</footer>",
    "sidebar": '<aside class="widget"><p>A sidebar text that is quite long and has sentences, too.</p></aside>',
    "notice": '<div class="cookie-notice"><p>We use cookies to make this page better for you.</p></div>',
    "advert": '<div class="ad">Buy this thing now, it is a very good thing.</div>',
    "form": "<form><label>Mail</label><input name=q><button>Send it</button></form>",
    "script": '<script>var t="</p><p>no text";</script><style>p{margin:0}</style>',
    "comments": '<section id="comments">' + "<p>I think this is a great article, thank you for it.</p>" * 40 + "</section>",
}


@pytest.mark.parametrize("part", sorted(AROUND))
@pytest.mark.parametrize("shape", ["article", "main", "class"])
def test_boilerplate_around_the_article_goes(fitted, part, shape):
    open_, close = {"article": ("<article>", "</article>"), "main": ('<div role="main">', "</div>"),
                    "class": ('<div class="content">', "</div>")}[shape]
    body = AROUND[part]
    for page in (f"<html><body>{body}{open_}{STORY}{close}</body></html>",
                 f"<html><body>{open_}{STORY}{close}{body}</body></html>",
                 f"<html><body>{open_}{STORY}{body}{close}</body></html>"):
        assert X.main_texts([page], fitted) == [WANT], page[:200]


def test_landmarks_in_comments_and_layout_names(fitted):
    comments = "<section class='comments'>" + "<article><p>A reader's comment, which is long enough.</p></article>" * 9 + "</section>"
    page = f"<body><div class='page has-sidebar'><article>{STORY}</article><div class='sidebar'>Other news.</div></div>{comments}"
    assert X.main_texts([page], fitted) == [WANT]


@pytest.mark.parametrize("word", ["category-legal", "social-media", "tag-share", "rail", "side", "ad", "form", "alert",
                                  "status-publish", "comment", "related"])
@pytest.mark.parametrize("shape", ["<article class='post {}'>", "<main class='story {}'>", "<div role=main id='{}'>",
                                   "<main><article class='{}'>"])
def test_landmarks_win_over_words_of_their_names(fitted, word, shape):
    mark = shape.format(word)
    page = f"<body>{AROUND['nav']}{mark}{STORY}</body>"
    for model in (fitted, X.potentials_from(np.zeros(X.N_COUNTS))):
        assert X.main_texts([page], model) == [WANT]
    assert "<div" in mark or X.labels_of(X.parse(page)) is not None


def test_articles_named_as_comments_beside_an_article(fitted):
    said = "<article class='comment depth-1'><div>" + "<p>I think this is a great article, thank you for it.</p>" * 3 + "</div></article>"
    assert X.main_texts([f"<body><article>{STORY}</article>{said * 3}</body>"], fitted) == [WANT]
    assert X.main_texts([f"<body><article>{STORY}{said}</article></body>"], fitted) == [WANT]


SAID = "<p>I think this is a great article, thank you for it.</p>"


@pytest.mark.parametrize("wrap", ["{}", "<div>{}</div>", "<div><div>{}</div></div>", "<div class=content><ol><li>{}</ol></div>"])
@pytest.mark.parametrize("shut", ["<section id='comments'>{}</section>", "<footer>{}</footer>", "<aside>{}</aside>",
                                  "<div hidden>{}</div>", "<div class='sidebar'>{}</div>"])
@pytest.mark.parametrize("n", [8, 60, 900])
def test_nothing_below_comments_or_hidden_parts_is_kept(fitted, wrap, shut, n):
    part = shut.format(wrap.format(SAID * n))
    for model in (fitted, X.potentials_from(np.zeros(X.N_COUNTS))):
        assert X.main_texts([f"<body><article>{STORY}</article>{part}</body>"], model) == [WANT]
        assert X.main_texts([f"<body><article>{STORY}{part}</article></body>"], model) == [WANT]


@pytest.mark.parametrize("wrap", ["<form id='aspnetForm'>{}</form>", "<div class='overlay-all'><div>{}</div></div>"])
@pytest.mark.parametrize("mark", ["<main>{}</main>", "<div role='main'>{}</div>", "<article>{}</article>"])
def test_landmarks_in_a_wrapper_of_the_page(fitted, wrap, mark):
    menu, comments = AROUND["menu"], f"<section id='comments'>{SAID * 3}</section>"
    assert X.main_texts([f"<body>{wrap.format(menu + mark.format(STORY))}</body>"], fitted) == [WANT]
    if "<article>" not in mark:
        assert X.main_texts([f"<body>{wrap.format(mark.format(STORY + comments) + comments)}</body>"], fitted) == [WANT]


def test_blocks_and_references(fitted):
    page = ("<article><h1>T&eacute;st &amp; more</h1><p>a <b>b</b>c\n  d<br>e<p>f &lt;g&gt; &#233; &amp x<div>i<ul><li>j<li>k</ul>"
            "</div>l<!-- no --></article>")
    assert X.main_texts([page], fitted) == ["Tést & more\na bc d e\nf <g> é & x\ni\nj\nk\nl"]


@pytest.mark.parametrize("mark", ["<![ endif]-->", "<![y] z>", "<![x>", "<![>", "<![endif]>", "<![if !IE]>", "<![CDATA[>",
                                  "<!x [y>", "<!ELEMENT [>", "<!>", "<?x>", "</ >", "<!DOCTYPE [x>"])
def test_pages_are_read_to_their_end(fitted, mark):
    assert X.main_texts([f"{mark}<article>{STORY}</article>"], fitted) == [WANT]
    assert X.main_texts([f"<article>{STORY}{mark}<p>And the last words of all.</p></article>"], fitted) == [
        f"{WANT}\nAnd the last words of all."]


def test_numbers_of_any_length_and_broken_marks(fitted):
    long = "&#" + "9" * 5000 + "; &#" + "0" * 5000 + "65;"
    assert X.main_texts([f"<article><p>a {long}</p>{STORY}</article>"], fitted) == [f"a \ufffd A\n{WANT}"]
    rng = np.random.default_rng(5)
    parts = ["<", "!", "[", "]", ">", "-", "--", "/", "p", " a=", "'", '"', "&", "#", "x", ";", "?", "CDATA[", "if", "DOCTYPE",
             "ELEMENT", "<script>", "</script>", "<p>", "\n", "9", "\0", "é"]
    for _ in range(3000):
        X.parse("".join(rng.choice(parts, rng.integers(1, 14))))


def test_marginals_are_exact(fitted):
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        parent = np.array([-1] + [int(rng.integers(0, i)) for i in range(1, n)])
        kind = rng.integers(0, 3, n)
        kinds = len(X.KINDS)
        model = X.Potentials(rng.normal(size=kinds), rng.normal(size=X.N_TEXT),
                             np.log(rng.random((kinds, 2, 2)) + 0.1), np.zeros(len(X.UNSURE_WORDS)))
        depth = np.zeros(n, int)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        weight = np.zeros((n, 2))
        for s in itertools.product((0, 1), repeat=n):
            w = sum(model.kind[kind[i]] * s[i] for i in range(n)) + sum(
                model.steps[kind[i], s[parent[i]], s[i]] for i in range(1, n))
            for i in range(n):
                weight[i, s[i]] += np.exp(w)
        got = model.marginals(X.Forest(parent, kind, np.zeros(n, int), depth, np.full(n, -1), np.zeros(1, int)))
        assert np.allclose(got, weight[:, 1] / weight.sum(axis=1))


def test_odd_rows(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<p>"), (3, "u", "&am"), (4, "u", "<article>" + "w " * 60000),
            (5, "u", deep), (6, "u", "<![x"), (6, "u", "<![x"), (7, "u", "<!DOCTYPE html><html"), (8, "u", "</p></a><b")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = X.extract_main_text(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by = {r.page_id: r for r in got}
    assert by[1].text == "" and by[1].n_chars == 0 and by[2].text == ""
    assert by[4].n_chars == 60000 * 2 - 1
    assert X.extract_main_text(df.limit(0)).count() == 0


DAY = "It was a long and very good day, and nothing else happened at all. The end came late."


def _fit(pages):
    return X.potentials_from(X.count_labelled([X.parse(p) for p in pages]))


@pytest.mark.parametrize("page,kept", [
    (f'<article><div class="side-by-side"><p>{DAY}</p></div></article>', 1),
    (f'<article><div class="poem form-sonnet"><p>{DAY}</p></div></article>', 1),
    (f'<div id="wrapper" class="page side-nav-layout"><article><p>{DAY}</p></article><article><p>{DAY}</p></article></div>', 2),
    (f'<div class="login-page"><p>{DAY}</p><p>{DAY}</p><p>{DAY}</p></div>', 3),
    (f'<article><p>{DAY}</p><section class="social-history"><p>{DAY}</p></section><div id="related-work"><p>{DAY}</p></div>'
     f'<p class="notice">{DAY}</p></article>', 4)])
def test_names_of_parts_of_a_story(spark, small, page, kept):
    pages = [r.html for r in spark.read.parquet(f"{small}/pages.parquet").select("html").collect()]
    assert X.main_texts([page], _fit(pages)) == ["\n".join([DAY] * kept)]


def test_names_inside_a_line_and_links_at_any_depth():
    model = _fit([])
    assert X.main_texts(['<article><p>FIRST <span class="search">and <b>second</b></span> end of it.</p></article>'], model) == [
        "FIRST and second end of it."]
    tree = X.parse("<a href=x>" + "<b>" * 9 + "deep</a>")
    assert [link for _, _, link, _ in tree.texts] == [True]


def test_training_changes_marginals_and_texts():
    """Pages whose related sections lie outside of the article teach that they are not part of it."""
    outside = f'<article><p>{DAY}</p></article><div class="related"><p>Another story of the day.</p></div>'
    inside = f'<article><p>{DAY}</p><div class="related"><p>{DAY}</p></div></article>'
    page = f'<article><p>{DAY}</p><div class="related"><p>{DAY}</p></div></article>'
    neutral = f'<div><p>Menu</p><p>About us</p></div><article><p>{DAY}</p><p>{DAY}</p></article>'
    models = [_fit([neutral] * 60), _fit([neutral, outside] * 60), _fit([neutral, inside] * 60)]
    forest = X.Forest.of([X.parse(page)])
    node = int(np.flatnonzero(forest.kind == X.UNSURE)[0])
    plain, against, for_it = (m.marginals(forest)[node] for m in models)
    assert against < 0.5 < plain < for_it
    assert [X.main_texts([page], m)[0].count(DAY) for m in models] == [2, 1, 2]


def test_reader_comments_and_link_lists_stay_out():
    page = (f'<article><p>{DAY}</p><section class="comments"><p>{DAY}</p><p>{DAY}</p></section><div class="related"><ul>'
            f'<li><a href=x>Other story</a></li><li><a href=x>More</a></li></ul></div></article>')
    assert X.main_texts([page], _fit([])) == [DAY]


def test_deep_and_flat_messages_agree(monkeypatch, spark, small):
    pages = [r.html for r in spark.read.parquet(f"{small}/pages.parquet").select("html").limit(15).collect()]
    model = _fit(pages)
    trees = [X.parse(p) for p in pages]
    flat = [model.marginals(X.Forest.of([t])) for t in trees]
    monkeypatch.setattr(X, "DEEP", 0)
    for t, want in zip(trees, flat):
        assert np.allclose(model.marginals(X.Forest.of([t])), want, atol=1e-9)


def test_time_is_linear_on_misnested_pages():
    import time
    model = _fit([])

    def seconds(n):
        page = f"<article><p>{DAY}</p>" + "<b><p>t</i>" * n + "</article>"
        t = time.perf_counter()
        text = X.main_texts([page], model)[0]
        assert text.startswith(DAY) and text.count("\nt") == n
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(40_000) < 2.6 * seconds(20_000)
