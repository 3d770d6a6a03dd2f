import pytest

from chartloom.llm import html

PAGES = "page_id long, url string, html string, host string"
ARTICLE = (
    '<html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div id="cookie-notice">Cookies are used</div>'
    '<div class="{cls}"><h2>Head &amp; line</h2><p>One   two <b>th</b>ree&nbsp;x.</p><div class="ad">Buy this now</div>'
    "<p><b>Second part of it<br>goes on<p>Third with <a href=x>a link</a> in it<form><p>Your name</p></form>"
    '<div class="comments"><p>A reader says a lot of things here, more than the article itself does, on and on.</p></div>'
    '</div><aside>Beside</aside><footer>&copy; me</footer>'
)
TEXT = "Head & line\nOne two three x.\nSecond part of it goes on\nThird with a link in it"


def test_article_without_what_surrounds_it():
    source = ARTICLE.format(cls="content")
    assert html.page_path(source).endswith("div.content")
    assert html.page_text(source, []) == TEXT


@pytest.mark.parametrize(
    "source,text",
    [
        (None, ""), ("", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<div><div>", ""),
        ("<ul><li>one long enough item<li>two</ul>", "one long enough item\ntwo"), ("<article><p>hi &am", "hi &am"),
        ("<!-- never closed", ""), ("<p title='a>b'>x</p>", "x"), ("<p>a</p>" * 3000, "\n".join(["a"] * 3000)),
        ('<nav>menu</nav><article class="post"><h1>T</h1><p>text here</p></article>', "T\ntext here"),
        ("<script>if (a</script><p>q</p>", "q"), ("<p>a&#233;&#x26;\n\tb</p>", "aé& b"), ("<table><tr><td>a<td>b</table>", "a\nb"),
    ],
)
def test_small_pages(source, text):
    assert html.page_text(source, []) == text


def test_host_votes_outweigh_one_page(spark):
    layout = '<body><div class="main{i}"><p>{main}</p></div><div class="extra"><p>{extra}</p></div></body>'
    rows = [
        (i, f"https://News.example.org/{i}", layout.format(i=i, main="article words " * 30, extra="related words"), "x")
        for i in range(5)
    ]
    rows += [(9, "http://news.example.org:80/9", layout.format(i=9, main="short article", extra="long " * 200), "x")]
    rows += [(10, None, "<p>alone</p>", None), (None, "no url", None, None), (9, *rows[5][1:])]
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    paths = {r.host: r.paths for r in html.host_paths(df).collect()}
    assert paths["news.example.org"][0].endswith("div.main")
    got = sorted(((r.page_id, r.text) for r in html.extract(df).collect()), key=str)
    assert [t for i, t in got if i == 9] == ["short article"] * 2
    assert dict(got)[10] == "alone" and dict(got)[None] == "" and len(got) == len(rows)
    assert html.extract(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("around", ["main", "div class=post"])
def test_heading_and_lead_beside_a_longer_body_stay(around):
    source = (
        f"<body><div class=top>Welcome to this site</div><{around}><h1>Head</h1><div class=lead><p>{'lead ' * 4}</p></div>"
        f"<div class=body><p>{'body ' * 16}</p></div></{around.split()[0]}><div class=more>Other text</div></body>"
    )
    assert html.page_text(source, []) == "\n".join(["Head", ("lead " * 4).strip(), ("body " * 16).strip()])
    linked = source.replace("<h1>Head</h1>", "<div class=x><a href=/1>one more of many</a> <a href=/2>and another of them</a></div>")
    assert html.page_text(linked.replace("lead ", ""), []) == ("body " * 16).strip()


def test_pages_of_a_smaller_template_keep_their_text(spark):
    short, long = '<div class="main"><p>In short</p></div>', '<div class="story{c}"><p>' + "story words " * 30 + "</p></div>"
    rows = [(i, "http://a.org/", f'<body><div class="main"><p>{"news words " * 30}</p></div></body>', "x") for i in range(9)]
    rows += [(20 + i, "http://a.org/", f"<body>{short}{long.format(c=c)}</body>", "x") for i, c in enumerate("ab" * 2 + "cdefghijkl")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i] for i in range(9)] == [("news words " * 30).strip()] * 9
    assert {got[i] for i in got if i >= 20} == {("story words " * 30).strip()}
    assert len(html.host_paths(spark.createDataFrame(rows, PAGES)).first().paths) == 13


LONG = "This is the article, and it has some words in it as articles do. " * 8


@pytest.mark.parametrize(
    "around",
    [
        '<div class="content no-sidebar">', '<div class="entry comments-open">', '<div id="social-history">',
        '<article class="post tags-spark related-science">', '<form id="aspnetForm">', '<div class="sidebar">',
        '<main class="comments-closed">', '<div class="share"><div class="legal">',
    ],
)
def test_no_name_takes_the_article_away(around):
    tags = [t.split()[0].strip("<>") for t in around.split("><")]
    close = "".join(f"</{t}>" for t in reversed(tags))
    beside = '<nav><p>Menu words</p></nav><div class="cookie-notice"><p>Cookies</p></div><div class="comments"><p>Me too</p></div>'
    assert html.page_text(f"<body>{beside}{around}<h1>Head</h1><p>{LONG}</p>{close}</body>", []) == f"Head\n{LONG.strip()}"


def test_names_take_away_what_they_name():
    names = "ad-slot sidebar-right post-comments-list js-cookie-consent-banner newsletter-signup related-posts footer2 google-advertisement"
    inside = "".join(f'<div class="{n}"><p>{n} says something or other</p></div>' for n in names.split())
    kept = "legal-analysis social-history related-science no-ads comments-policy-debate"
    stays = "".join(f'<div class="{n}"><p>{n} is told</p></div>' for n in kept.split())
    text = html.page_text(f"<article><p>{LONG}</p>{inside}{stays}</article>", [])
    assert text.split("\n") == [LONG.strip(), *(f"{n} is told" for n in kept.split())]


def test_long_comments_and_sidebars_do_not_become_the_article():
    page = '<body><div class="story"><p>{}</p></div><div class="{}"><p>{}</p></div></body>'
    for name in ("comments", "reader-replies", "sidebar"):
        assert html.page_text(page.format("A short story is told here. " * 9, name, "words " * 120), []).startswith("A short story")
    # A small notice is no article, however short the article is.
    assert html.page_text(page.format("Too short.", "cookie-notice", "We keep some cookies on this page."), []) == "Too short."
    assert html.page_text(f'<div class="comments"><p>{LONG}</p></div>', []) == ""


def test_an_article_of_comments_is_no_article():
    page = f'<body><div class=post><p>{LONG}</p></div><div class=comments><article class=comment><p>I say.</p></article></div></body>'
    assert html.page_text(page, []) == LONG.strip()
