"""Main text: structure, broken markup, and templates counted per host."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html, queries

SCHEMA = "page_id long, url string, html string"


def text(source):
    return html.Page(source).text()


@pytest.mark.parametrize(
    "source, expected",
    [
        ("", ""),
        ("   ", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\nb"),
        ("<p>a <b>b</b>\n\t c<br>d</p>", "a b c d"),
        ("<div>x<p>y</div>z", "x\ny\nz"),
        ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>", "1\n2\n3\n4"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<p>&lt;p&gt; &#233;&eacute;&nbsp;&nbsp;x &amp;amp; &bogus; &am", "<p> éé x &amp; &bogus; &am"),
        ("a < b <3 <", "a < b <3 <"),
        ("<p>one<!-- <p>no -->two", "onetwo"),
        ("<p>one<!-- open", "one"),
        ("<p>one</p><p class='x", "one"),
        ('<a href="x>y" title=\'<p>\'>l</a>', "l"),
        ("<a href='x>broken</a> t", "broken t"),
        ("<script>if (a<b) '</p>'</script>t<style>p{}</style>", "t"),
        ("<script>open", ""),
        ("<title>T</title><p>x", "x"),
        ("<!DOCTYPE html><?xml?><p>x</p>", "x"),
        ("<nav>n</nav><header>h</header><p>x</p><aside>s</aside><footer>f</footer>", "x"),
        ("<article><header><h1>t</h1></header><p>x</p></article>", "t\nx"),
        ("<p>out</p><article>in</article><p>out</p>", "in"),
        ("<main><h1>t</h1><p>x</p></main><p>out</p>", "t\nx"),
        ("<article>one</article><article>two</article>", "one\ntwo"),
        ("<article>x<article class='comment'>no</article></article>", "x"),
        ("<form>f<input>g</form><p>x", "x"),
        ("<div id=cookieNotice>c</div><div class='post-content'>x</div>", "x"),
        ("<article><p>x</p><div class=\"ad\">buy</div><div class='ad-box'>b</div></article>", "x"),
        ("<article><section id='comments'>c</section>x<div role=complementary>r</div></article>", "x"),
        ("<body class='has-sidebar no-comments'><article class='notice'>x</article>", "x"),
        ("<p hidden>h</p><p style='display: none'>h</p><p aria-hidden=true>h</p>x", "x"),
        ("<div class='address badge reader'>x</div>", "x"),
        ("<article><div class='commentList'>c</div><p class=\"site-alert\">a</p>x</article>", "x"),
        ("<h1>a</h1>tail<h2>b</h2>", "a\ntail\nb"),
        ("</p></div>x</b>", "x"),
        ("<P>A</P><DIV CLASS=Ad>n</DIV>", "A"),
    ],
)
def test_pages(source, expected):
    assert text(source) == expected


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<div class='layout has-sidebar'><article><p>x</article><div class=sidebar>s</div></div>", "x"),
        ("<div class='content no-comments'><p>x</div><div class='comments'><p>long comment</div>", "x"),
        ("<div class='post social'><article>x</article></div>", "x"),
        ("<div class='post social'><main><p>x</main></div>", "x"),
        ("<div class='post social'><p>the long text</div><div class=ad><p>buy</div>", "the long text"),
        ("<article><div class='share'><p>the long text</div><div class=related><p>t</div></article>", "the long text"),
        ("<div id=sidebar-layout><article>x</article><div class=sidebar><article>teaser</article></div></div>", "x"),
        ("<article><p>x</p></article><div class=comments><article class=comment><p>long one</article></div>", "x"),
        ("<main><p>the text</p><div class=related><article>t</article></div></main>", "the text"),
        ("<main><div class='post social'><article><p>x</article></div></main>", "x"),
        ("<div class=withAds><p>x</div><nav><p>much longer menu</nav><p class=ad>much longer advert", "x"),
    ],
)
def test_wrappers_with_listed_words(source, expected):
    assert text(source) == expected


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<body><form id=aspnetForm><article><p>x</p><input></article></form>", "x"),
        ("<body><form><div><p>the long text</p><p>more</p></div></form><form>search<input></form>", "the long text\nmore"),
        ("<article><p title=don't>Hello world</p><p>middle</p><p>it's fine</p></article>", "Hello world\nmiddle\nit's fine"),
        ("<article>" + "".join(f"<div class=elementor-widget-container><p>{n}</div>" for n in "abc") + "</article>", "a\nb\nc"),
        ("<div class=entry>" + "".join(f"<div class=widget>{n}</div>" for n in "abc") + "</div>", "a\nb\nc"),
        ("<article><p>x</p><section id=discussion><h2>Discussion</h2><p>y</p></section></article>", "x\nDiscussion\ny"),
        ("<article><div class=related-work><p>x</p></div><section id=ad-2020><p>y</section><p>z</article>", "x\ny\nz"),
        ("<div role=form><article><p>x</p></article></div>", "x"),
        ("<div style='display:none'><article><p>x</p></article></div>", "x"),
        ("<div hidden><main><p>x</p></main></div>", "x"),
        ("<div style='display:none'><p>a longer hidden text</p></div><p>x</p>", "x"),
        ("<article><div class=widget><a href=x>one</a> <a href=y>two</a></div><p>x</p></article>", "x"),
        ("<article><div class=my-related-things><a href=x>one</a></div><p>x</p></article>", "x"),
        ("<article><div class=ad-slot>buy</div><div class='inline-ad'>b</div><p>x</p></article>", "x"),
        ("<p title=\"a class=ad b\">x</p>", "x"),
        ("<p title='a' class=\"ad\">n</p><div><p>x</p><p>y</p></div>", "x\ny"),
        ("<a title=a\"b href='x'>l</a>", "l"),
    ],
)
def test_articles_are_kept(source, expected):
    assert text(source) == expected


def test_long_pages_are_read_whole():
    body = "".join(f"<p>block {i} &amp; more</p>" for i in range(20_000))
    assert text(body).count("\n") == 19_999
    assert text("<div>" * 50_000 + "deep") == "deep"


def page(n, extra="", repeated="<div><span>Our partners</span> page list</div>"):
    return f"<body>{repeated}<p>own {n}</p><p>shared sentence</p>{extra}</body>"


def extracted(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit(1) for c in ("host", "key", "cut", "hashes", "text")})
    return {r.page_id: r.text for r in html.extract(df, **options).collect()}


def test_recurring_subtrees_go_and_paragraphs_stay(spark):
    rows = [(n, f"https://A.example/{n}?q", page(n)) for n in range(6)]
    # the same block on too few pages of another host
    rows += [(100 + n, f"http://b.example/{n}", page(n)) for n in range(4)]
    rows += [(400, None, page(0)), (401, "no host", None), (402, "http://a.example/z", "")]
    found = extracted(spark, rows)
    assert all(found[n] == f"own {n}\nshared sentence" for n in range(6))
    assert all(found[100 + n] == f"Our partners page list\nown {n}\nshared sentence" for n in range(4))
    assert found[400].startswith("Our partners") and found[401] == found[402] == ""


def test_templates_inside_articles(spark):
    block = "<div>Read more like this</div>"
    rows = [(n, "http://a/x", f"<article><p>own {n}</p>{block}<p>same</p></article>") for n in range(8)]
    assert all(t == f"own {n}\nsame" for n, t in extracted(spark, rows).items())
    assert extracted(spark, rows, min_pages=9)[0] == "own 0\nRead more like this\nsame"


def test_copies_of_an_article_are_no_evidence(spark):
    body = "".join(f"<p>sentence number {i} of the article</p>" for i in range(20))
    article = f"<article><h1>title</h1><div class=content>{body}</div><table><tr><td>a row</table>"
    block = "<div>Read more like this</div>"
    rows = [(n, f"http://a/{n}", f"{article}{block}</article>") for n in range(7)]
    rows += [(10 + n, f"http://a/near{n}", f"{article}{block}<p>read {n} times</p></article>") for n in range(9)]
    told = " ".join(f"word{i}" for i in range(9))
    rows += [(30 + n, f"http://a/x{n}", f"<article><p>{told} {n}</p>{block}</article>") for n in range(8)]
    found = extracted(spark, rows)
    for n in range(7):
        assert found[n].count("sentence number") == 20 and found[n].endswith("a row")
    for n in range(10, 19):
        assert found[n].count("sentence number") == 20 and found[n].endswith(f"a row\nread {n - 10} times")
    assert all(found[30 + n] == f"{told} {n}" for n in range(8))


def test_the_bar_does_not_grow_with_the_host(spark):
    rows = [(n, f"http://a/{n}", page(n)) for n in range(html.MIN_PAGES)]
    rows += [(1000 + n, f"http://a/x{n}", f"<p>other {n}</p>") for n in range(1000)]
    found = extracted(spark, rows)
    assert all(found[n] == f"own {n}\nshared sentence" for n in range(html.MIN_PAGES))
    assert extracted(spark, rows[1:])[1].startswith("Our partners")


class Tree(HTMLParser):
    """Well-formed pages as nested lists: tag, class, children."""

    def __init__(self, source):
        super().__init__()
        self.open = [("", "", [])]
        self.feed(source)

    def handle_starttag(self, tag, attributes):
        node = (tag, dict(attributes).get("class", ""), [])
        self.open[-1][2].append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        self.open[-1][2].append(data)


def walk(node):
    yield node
    for child in node[2]:
        if not isinstance(child, str):
            yield from walk(child)


def kept_text(node, templates):
    if isinstance(node, str):
        return node
    if node[0] in html.CONTAINERS and repr(node) in templates:
        return ""
    inner = "".join(kept_text(child, templates) for child in node[2])
    return f"\n{inner}\n" if node[0] in html.BLOCKS else inner


def test_templates_against_a_loop_over_hosts_and_subtrees(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    said = lambda n: " ".join(rng.choice(words) for _ in range(n))

    def block(depth):
        inner = "".join(block(depth - 1) if depth and rng.random() < 0.6 else f"<p>{said(4)}</p>" for _ in range(2))
        return f"<{(tag := rng.choice(['div', 'section', 'ul']))} class=c{rng.randrange(3)}>{inner}</{tag}>"

    rows = []
    for h in range(6):
        shared = [block(2) for _ in range(4)]
        for n in range(rng.choice([3, 6, 25])):
            used = [b for b in shared if rng.random() < 0.5]
            parts = [*used, *(f"<p>{said(30)}</p>" for _ in range(2)), block(1)]
            rng.shuffle(parts)
            rows.append((len(rows), f"http://h{h}/{n}", f"<article>{''.join(parts)}</article>"))
    pages = {i: (url.split("/")[2], Tree(source).open[0]) for i, url, source in rows}
    beside = {}
    for i, (host, tree) in pages.items():
        for node in walk(tree):
            if node[0] in html.CONTAINERS:
                beside.setdefault(host, {}).setdefault(repr(node), set()).add(i)
    found = extracted(spark, rows)
    gone = 0
    for i, (host, tree) in pages.items():
        templates = {node for node, held in beside[host].items() if len(held) >= html.MIN_PAGES}
        gone += any(repr(node) in templates for node in walk(tree))
        lines = (" ".join(line.split()) for line in kept_text(tree, templates).split("\n"))
        assert found[i] == "\n".join(line for line in lines if line)
    assert 20 < gone < len(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "http://a/", page(1))] * 3 + [(None, None, None)]
    found = html.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 4 and len({r.text for r in found}) == 2
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    """The generated pages hold one article each, whose text a plain pattern finds too."""
    import re
    from html import unescape

    folder = "/root/testdata/sf0.001"
    sources = dict(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect())
    found = queries.html_query(spark, folder).collect()
    assert len(found) == len(sources)
    for row in found:
        inner = re.search("<article>(.*)</article>", sources[row.page_id], re.S)[1]
        inner = re.sub("<[a-z/][^>]*>", " ", re.sub("</?(p|h1)>", "\0", inner))
        blocks = [" ".join(unescape(b).split()) for b in inner.split("\0")]
        assert row.text == "\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text)
