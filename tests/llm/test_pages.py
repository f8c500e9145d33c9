import awkward
import pytest
from tellwatt.llm.pages import extractor, op8_pages

ARTICLE = "<h1>Ten words or so</h1><p>First, a sentence &amp; more.</p><p>Short.</p><ul><li>one <a href=x>link</a></li><li>two</li></ul>"
TEXT = "Ten words or so\nFirst, a sentence & more.\nShort.\none link\ntwo"
NAV = "<nav><ul>" + "".join(f"<li><a href=/{k}>Section number {k}, and a long name.</a></li>" for k in range(9)) + "</ul></nav>"
WRAPPED = [
    "<html><body>{nav}<article>{a}</article><footer>&copy; all, of it. And more.</footer></body></html>",
    "<html><body><header><h1>Site</h1></header>{nav}<main>{a}</main><aside>Related, things. Here.</aside>",
    "<body><div class='top-menu'><a href=1>Home page of it.</a></div><div id=content>{a}</div><div class='reader-comments'><p>I think, so. Too.</p></div></body>",
    "<body><div class=cookie-notice>We use, cookies. A lot of them, always.</div><div class='post'>{a}<div class='ad'>Buy, now.</div></div><form>Name, <input></form></body>",
    "<article><header>{a}</header><script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><noscript>no, no.</noscript></article>",
    "<body><div class=wrap><div class=column>{a}</div><div class=sidebar>Side, text. And more of it.</div></div></body>",
]


@pytest.mark.parametrize("page", WRAPPED)
def test_article_of_a_page(page):
    assert extractor()(page.format(a=ARTICLE, nav=NAV)) == TEXT


def test_broken_and_odd_pages():
    extract = extractor()
    assert extract(None) == extract("") == extract("   ") == extract("<p></p>") == extract("<script>x") == ""
    assert extract("just text, no markup &lt;b") == "just text, no markup <b"
    assert extract("<article><h1>T</h1><p><b>one, two.<br><p>three</p><p>four &eacute;&#33;\n\t x&nbsp;y<br>z</article>") == "T\none, two.\nthree\nfour é! x y z"
    assert extract("<article><p>a < b and c</p><p>end") == "a < b and c\nend"
    assert extract("<article>" + "<p>again, and again.</p>" * 3000 + "</article>").count("\n") == 2999


def test_query(spark, tmp_path):
    rows = [(1, "u", WRAPPED[0].format(a=ARTICLE, nav=NAV), "x"), (2, None, None, "x"), (None, "v", "", None), (1, "u", "<article>é日</article>", "x")]
    folder = awkward.saved(spark, f"{tmp_path}/a", pages=spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    got = sorted(map(tuple, op8_pages(spark, folder).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "", 0), (1, "u", "é日", 2)], key=str)
    folder = awkward.saved(spark, f"{tmp_path}/b", pages=spark.createDataFrame([], "page_id long, url string, html string"))
    assert op8_pages(spark, folder).collect() == []


@pytest.mark.parametrize("page", [
    "<body><div class='no-sidebar'>{a}</div></body>", "<body><div class='has-sidebar comments-open'>{a}</div></body>",
    "<body><form id=aspnetForm action=x><div>{a}</div></form></body>", "<body>{nav}<form><div class='sidebar'>{a}</div></form></body>",
    "<body><article><div class='article-header'>{a}</div></article></body>",
])
def test_names_do_not_lose_the_article(page):
    assert extractor()(page.format(a=ARTICLE, nav=NAV)) == TEXT


def test_headings_named_like_other_parts_stay():
    page = "<article><h2 id='discussion'>Said of it</h2><p>One, two. Three.</p><section id='related-work'><p>Four, five. Six.</p></section></article>"
    assert extractor()(page) == "Said of it\nOne, two. Three.\nFour, five. Six."


@pytest.mark.parametrize("part", [
    "div class='comment-list'", "section id='comments-section'", "div class='comment-body'", "div class='sidebar-inner'", "div class='related-posts'",
    "div class='cookie-bar'", "div class='newsletter-box'", "div class='ad-container'", "div class='post-comments'", "form action=x",
])
@pytest.mark.parametrize("page", [
    "<body>{nav}<article>{a}{part}</article></body>", "<body>{part}<div class=wrap><div>{a}</div></div>{nav}</body>",
    "<body><div id=content>{part}{a}</div></body>", "<body>{nav}<form><div class='post'>{a}{part}</div></form></body>",
])
def test_marked_parts_stay_out(page, part):
    inner = "<p>I think, that is so. And, what is more, it always was.</p><div><p>So, say others. Again, and again.</p></div>"
    made = f"<{part}>{inner}</{part.split()[0]}>"
    assert extractor()(page.format(a=ARTICLE, nav=NAV, part=made)) == TEXT


def test_quoted_ends_of_tags():
    extract = extractor()
    assert extract("<article><p>One <img alt='a > b'>two.</p><p title=\"x>y\" data-a = '>'>Three.</p></article>") == "One two.\nThree."
    assert extract("<article><p class=it's>One.</p><p class=\">Two.</p></article>") == "One.\nTwo."


@pytest.mark.parametrize("opened", ["<blockquote>", "<b><p>", "<div>", "<li>", "<b>", "<div>x", "<p><b>x", "<ul><li>x", "</p>", "<a x='"])
def test_deep_pages_take_time_in_proportion(opened):
    from time import process_time

    extract, start = extractor(), process_time()
    extract("<article>" + opened * 50000 + "end, of it.")
    assert process_time() - start < 3
