import random

import pytest

from celltrace.llm import page_text
from tests.llm.helpers import nothing, with_clashes

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("plain", "plain"), ("a < b &amp; c", "a < b & c"), ("<p>a<br>b</p>c", "a b\nc"),
        ("<ul><li>1<li>2</ul><table><tr><td>q<td>r</table>", "1\n2\nq\nr"), ("<p>a <b>bo<i>ld</b> x</p>", "a bold x"),
        ("<article><p>one\n\t two&nbsp;three</p></article><p>outside</p>", "one two three"),
        ("<main>m<article><h1>T &am</h1>x</article></main>", "T &am\nx"), ("<body><main><p>a</p><footer>f</footer></main><p>b", "a"),
        ("<script>var t='</p>';</script><style>p{}</style><p>a</p><noscript>n</noscript>", "a"), ("<p>a<!-- <p>b</p> -->c</p><!-- open <p>d", "ac"),
        ('<div class="ad">x</div><div id="user-comments"><p>c</p></div><div class="cookie-bar">k</div><p>a</p>', "a"),
        ('<article><header><h1>T</h1></header><p>a</p><div class="commentlist">c</div><form>f</form></article>', "T\na"),
        ('<header>h</header><nav>n</nav><aside>s</aside><p hidden>z</p><p style="display: none">y</p><p>a</p>', "a"),
        ('<p title="a>b">k</p>', "k"), ("<p>&#8364;&eacute;&#x4e2d;&copy</p>", "€é中©"), ("<div role=navigation>n</div>t", "t"), ("<p>a</div>b</p>c", "a\nb\nc"),
        ("<title>t</title><p>x</p></body></html>", "x"), ("<a href=x>l</a> <br/> m<hr>n<![CDATA[o]]>", "l m\nno"), ("<p>cut <b", "cut"),
    ],
)
def test_main_text(html, text):
    assert page_text.main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ('<div class="layout has-sidebar"><article><p>story</p></article></div>', "story"), ('<div class="sidebar-layout"><article><p>story</p></article></div>', "story"),
        ('<div class="no-ads"><p>story</p></div><div class="no-ads"><p>story</p></div>', "story\nstory"),
        ('<article><p>a long enough text</p><section id="related-work"><p>b</p></section><h2 id="social-history">c</h2></article>', "a long enough text\nb\nc"),
        ('<article><p>a long enough text</p><div id="share-prices">b</div><div class="commentary">c</div><div id="share">d</div></article>', "a long enough text\nb\nc"),
        ('<article><div class="widget"><p>the whole article</p></div></article><p>links and links and links and links</p>', "the whole article"),
        ('<article><p>a long enough text</p></article><div class="related"><article>card</article></div>', "a long enough text"),
        ('<p>a long enough text</p><div class="related"><article>card</article></div>', "a long enough text\ncard"),
        ('<article><p>a long text <span class="ad">buy</span> goes on</p></article>', "a long text\ngoes on"),
        ("<article><p>story</p><div class='comments'>" + "<p>I think so too, and so does everybody else</p>" * 8 + "</div></article>", "story"),
        ("<main><p>story</p><section id=comments>" + "<article>I think so too</article>" * 8 + "</section></main>", "story"),
        ("<div><p>story</p></div><section id=comments>" + "<article>I think so too</article>" * 8 + "</section>", "story"),
        ('<p>story</p><div class="menu"><p>one link after the other, and one more link</p></div>', "story"), ('<div class="comments"><p>only</p></div>', "only"),
        ('<p hidden="hidden">z</p><p data-hidden="x" data-id="menu">a</p>', "a"), ('<article><h2 id="menu">Menu</h2><p>a</p></article>', "Menu\na"),
    ],
)
def test_names_delete_small_parts_only(html, text):
    assert page_text.main_text(html) == text


def site(n):
    box = "<div class=box><p>Follow us on our channels</p><p>Call 555</p></div>"
    rows = []
    for i in range(n):
        body = f"{box}<div><p>Story {i} of some length that is its own.</p><p>Shared passage that every page prints.</p></div>"
        rows.append((i, f"http://Site.example/{i}", f"<html><body>{body}</body></html>"))
    return rows


def test_templates_go_and_shared_passages_stay(spark):
    rows = site(12) + [(100, "http://other.example/1", site(1)[0][2]), (101, None, site(1)[0][2]), (102, "not a url", site(1)[0][2]), (103, "http://site.example/x", None), (None, "http://site.example/y", "")]
    found = {r.page_id: r for r in page_text.extract(with_clashes(spark.createDataFrame(rows, PAGES))).collect()}
    assert len(found) == len(rows)
    for i in range(12):
        assert found[i].text == f"Story {i} of some length that is its own.\nShared passage that every page prints."
        assert found[i].url == rows[i][1]
    for i in (100, 101, 102):
        assert found[i].text.startswith("Follow us on our channels\nCall 555\nStory 0")
    assert found[103].text == "" and found[None].text == "" and all(r.n_chars == len(r.text) for r in found.values())


def test_templates_of_large_hosts(spark):
    """A box on six of 200 pages is a template like on a host of 50."""
    box = "<div><p>Section menu</p></div>"
    rows = [(i, "http://big.example/", f"<body>{box if i < 6 else ''}<p>Story {i} that is longer than any of the boxes.</p></body>") for i in range(200)]
    found = {r.page_id: r.text for r in page_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"Story {i} that is longer than any of the boxes." for i in range(200)}


def test_page_that_repeats_whole_is_no_template(spark):
    rows = [(i, "http://a.example/", "<article><div><p>The same article.</p></div></article>") for i in range(20)]
    assert {r.text for r in page_text.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"The same article."}


def brute(rows, least=5):
    """Templates and texts of every page, counted in plain Python from the rows of the pages alone."""
    pages = [(i, (u or "").split("/")[2].lower() if "//" in (u or "") else None, page_text.Page(h or "").rows()) for i, u, h in rows]
    out = {}
    for host in {h for _, h, _ in pages}:
        mine = [p for _, h, p in pages if h == host]
        seen, votes = {}, {}
        for texts, _, _, parts in mine if host else []:
            for v in {("block", t) for t in texts} | {("part", v) for v, *_ in parts}:
                seen[v] = seen.get(v, 0) + 1
        for texts, _, places, parts in mine if host else []:
            bit = 1 if any(p & 1 for p in places) else 2 if any(p & 2 for p in places) else 0
            main = [i for i, p in enumerate(places) if not bit or p & bit]
            voted = set()
            for v, first, last in parts:
                rest = [i for i in main if not first <= i < last]
                alone = sum(len(texts[i]) for i in rest if seen["block", texts[i]] < least)
                if seen["part", v] >= least and rest and 2 * alone >= sum(len(texts[i]) for i in rest):
                    voted.add(v)
            for v in voted:
                votes[v] = votes.get(v, 0) + 1
        gone = {v for v, n in votes.items() if n >= least}
        for i, h, (texts, _, places, parts) in pages:
            if h == host:
                left = [n for n in range(len(texts)) if not any(v in gone and a <= n < b for v, a, b in parts)] or range(len(texts))
                bit = 1 if any(places[n] & 1 for n in left) else 2 if any(places[n] & 2 for n in left) else 0
                out.setdefault(i, []).append("\n".join(texts[n] for n in left if not bit or places[n] & bit))
    return out


def extracted(spark, rows):
    out = {}
    for r in page_text.extract(spark.createDataFrame(rows, PAGES)).collect():
        out.setdefault(r.page_id, []).append(r.text)
    return out


def test_extract_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = site(9)
    boxes = [f"<{t}><li>box {k}<li>more {k}</{t}>" for k, t in enumerate(["ul", "div", "section", "ol", "article"])]
    for i in range(160):
        stories = [f"<p>story {rnd.randrange(60)} with words {rnd.randrange(40)}</p>" for _ in range(rnd.randint(0, 4))]
        some = rnd.sample(boxes, rnd.randint(0, 3))
        parts = stories + some
        rnd.shuffle(parts)
        body = "".join(parts)
        tag = rnd.choice(["article", "main", "div", "body"])
        rows.append((100 + i, f"https://{rnd.choice(['hot', 'hot', 'a', 'B'])}.example/{i}", f"{rnd.choice(boxes)}<{tag}>{body}</{tag}>{rnd.choice(boxes)}"))
    rows += [(900, None, rows[20][2]), (901, "http://hot.example/", None)] + rows[30:33]
    expected = brute(rows)
    found = extracted(spark, rows)
    assert {i: sorted(t) for i, t in found.items()} == {i: sorted(t) for i, t in expected.items()}
    assert sum(found[i] != ["\n".join(page_text.main_text(h).split("\n"))] for i, _, h in rows) > 30  # templates decide


def test_templates_outside_the_article_decide(spark):
    """A teaser that is an article itself, on every page of a host: only counting tells it from the story."""
    teaser = "<div class=x1><article><h2>Our great offer of the month</h2><p>Subscribe to all channels at once</p></article></div>"
    rows = [(i, "http://n.example/", f"{teaser}<article><p>Story {i}</p><p>It goes on for {i} lines</p></article>") for i in range(6)]
    assert extracted(spark, rows) == {i: [f"Story {i}\nIt goes on for {i} lines"] for i in range(6)}
    assert all(text[0].startswith("Our great offer") for text in extracted(spark, rows[:4]).values())


PARTS = "<section><h2>One</h2><p>First part of it.</p></section><section><p>Second part.</p></section><ul><li>x<li>y</ul><table><tr><td>q<td>r</table><section><p>Third.</p></section>"


@pytest.mark.parametrize("n", [5, 30])
def test_repeated_articles_stay_whole(spark, n):
    whole = "One\nFirst part of it.\nSecond part.\nx\ny\nq\nr\nThird."
    rows = [(i, "http://a.example/", f"<nav>n{i}</nav><div class=ad>{i}</div><article>{PARTS}</article><footer>{i}</footer>") for i in range(n)]
    assert extracted(spark, rows) == {i: [whole] for i in range(n)}
    near = [(i, "http://a.example/", f"<article>{PARTS}<p>Edition {i}</p></article>") for i in range(n)]
    assert extracted(spark, near) == {i: [f"{whole}\nEdition {i}"] for i in range(n)}


def test_empty_table_and_long_pages(spark):
    assert page_text.extract(nothing(spark, PAGES)).collect() == []
    rows = [(1, "http://a.example/", "<div>" * 30_000 + "deep"), (2, "http://a.example/", "<p>" + "word " * 400_000), (3, "http://a.example/", '<div class="' * 5000), (4, "http://a.example/", "<" * 50_000)]
    found = {r.page_id: r.n_chars for r in page_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[1] == 4 and found[2] == 400_000 * 5 - 1
