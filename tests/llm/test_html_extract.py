import html
import re

from pyspark.sql import functions as F

from markbook.llm import html_extract as hx
from markbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_query_on_all_pages(spark):
    """The pages' articles hold nothing but headings, paragraphs, bold text and line breaks, so a pattern finds their text."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op8_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        parts = re.sub(r"</?(b|br)>", " ", re.sub(r"</?(p|h1)>", "\0", article)).split("\0")
        want = "\n".join(filter(None, (" ".join(html.unescape(p).split()) for p in parts)))
        assert (r.text, r.n_chars) == (want, len(want))


def test_furniture_goes():
    page = """<html><head><title>T</title><style>x{}</style><script>if (a < b) { w("<p>no</p>") }</script></head><body>
      <header><h1>Site</h1></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use</div>
      <div id="content"><article class="post-17"><h2>Head &amp; line</h2><p>First <b>bold</b>, <a href="x">link</a>.<br>More
      text &#233;&eacute; here</p><div class="adBox ad">Buy</div><form><input value="q"><p>Mail</p></form>
      <ul><li>One<li>Two</ul><blockquote>Quote<!-- not --> end</blockquote><table><tr><td>a<td>b</table>
      <section id="comments"><p>Nice!</p></section></article></div><aside>Side</aside><footer>&copy;</footer></body></html>"""
    want = "Head & line\nFirst bold, link. More text éé here\nOne\nTwo\nQuote end\na\nb"
    assert hx.extract(page, None) == want
    assert hx.best_container(hx.parse(page))[0].endswith(">article.post-#")


def test_broken_pages():
    assert hx.extract(None, None) == hx.extract("", "x") == hx.extract("<p", None) == hx.extract("<!-- open", None) == ""
    assert hx.extract("no tags &lt;b&gt;", None) == "no tags <b>"
    assert hx.extract("<body><p>cut <a href='x", None) == "cut"
    assert hx.extract("<body><script>var a = 1", None) == ""
    assert hx.extract("<p>a<p>b</div></p>c", None) == "a\nb\nc"
    assert hx.extract("<article><p>a < b and c</article>", None) == "a < b and c"
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert hx.extract(deep, None) == "x"
    assert hx.extract("<body><p>" + "word " * 200_000 + "</p>", None) == " ".join(["word"] * 200_000)


def test_a_host_outvotes_a_page(spark):
    """Where one page's related stories are longer than its article, the host's other pages decide."""
    normal = "<body><div class='story n{0}'><p>{1}</p></div><div class='more'><p>short</p></div></body>"
    odd = "<body><div class='story n9'><p>brief</p></div><div class='more'><p>" + "other " * 50 + "</p></div></body>"
    rows = [(i, "https://h.example/a", normal.format(i, "text " * 20)) for i in range(3)] + [(3, "https://h.example/b?c", odd), (4, "https://i.example/", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("q") for c in ("host", "path", "text", "n")})
    out = hx.extract_main_text(spark, pages)
    assert set(out.columns) == set(pages.columns)
    found = {r.page_id: r.text for r in out.collect()}
    assert found[3] == "brief" and found[4] == " ".join(["other"] * 50) and found[0] == " ".join(["text"] * 20)


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", "<p>x"), (2, "http://a", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in hx.extract_main_text(spark, pages).collect()) == ["", "", "", "x"]
    assert hx.extract_main_text(spark, pages.limit(0)).count() == 0


WORDS = " ".join(f"word{i}" for i in range(30))


def test_names_alone_cut_no_article():
    for page in (
        f'<body><div class="overflow-hidden"><p>{WORDS}</p></div></body>',
        f'<body><div class="a hidden-xs hidden b"><p>{WORDS}</p></div></body>',
        f'<body><div class="elementor-widget-container"><p>{WORDS}</p></div></body>',
        f'<body><article><div class="share-story"><p>{WORDS}</p></div></article></body>',
        f'<body><div id="search-results-article"><p>{WORDS}</p></div></body>',
        f'<body><article><div class="comments"><p>{WORDS}</p></div></article></body>',
        f"<body><main><p>{WORDS} <span class=\"social\"></span></p></main></body>",
    ):
        assert hx.extract(page, None) == WORDS, page


def test_hidden_by_attribute():
    for attrs in ("hidden", 'hidden=""', 'id="x" hidden class="y"', 'style="color:red; display : none"', "aria-hidden=true", "class=a hidden"):
        assert hx.extract(f"<body><article><p>{WORDS}</p><div {attrs}><p>gone</p></div></article>", None) == WORDS, attrs
    for attrs in ('class="hidden"', 'title="display:none"', 'data-hidden="1"', 'id="not-hidden"'):
        assert hx.extract(f"<body><article><p>{WORDS}</p><div {attrs}><p>kept</p></div></article>", None) == f"{WORDS}\nkept", attrs


def test_doubtful_parts_go_where_they_are_few():
    page = f'<body><article><div class="share-story"><p>{WORDS}</p><div class="ad">buy</div><div class="share">tell</div></div><div class="related"><p>more</p></div></article></body>'
    assert hx.extract(page, None) == WORDS


def test_comments_go_also_where_they_are_most():
    page = f'<body><div class="post"><div class="text"><p>{WORDS}</p></div><div class="comments"><p>{WORDS} {WORDS} {WORDS}</p></div></div></body>'
    assert hx.extract(page, None) == WORDS


def test_many_hosts_join_by_parts(spark, monkeypatch):
    rows = [(i, f"https://h{i % 7}.example/", f"<body><div class='c'><p>{'text ' * 9}{i}</p></div></body>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = lambda: sorted(r.text for r in hx.extract_main_text(spark, pages).collect())
    want = texts()
    monkeypatch.setattr(hx, "BROADCAST_BYTES", 0)
    assert texts() == want


def test_ties_of_votes_go_to_the_longer_text_then_the_name(spark):
    page = "<body><div class='{}'><p>{}</p></div></body>"
    rows = [("h", page.format("b", "x" * 30)), ("h", page.format("a", "x" * 30)), ("i", page.format("b", "x" * 40)), ("i", page.format("a", "x" * 30))]
    paths = hx.host_paths(spark.createDataFrame(rows, "host string, html string"))
    assert {r.host: r.path for r in paths.collect()} == {"h": ">body>div.a", "i": ">body>div.b"}
