import html
import re
import time

import pytest

from reelhouse.llm import html_extraction, url_rules
from reelhouse.llm.queries import RULES
from tests.conftest import SAMPLE_FOLDER, plan_of, rows_of


def plain_judgement(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


URLS = [
    "https://a.Example.ORG/en/12?x#y", "http://example.org/es/", "http://example.org", "example.org/es/",
    None, "", "://", "http://x.com/de/?q", "HTTP://com/fr/x", "http://notcom/de/", "http://a..com/de/",
    "http://example.org/en/2", "http://ÀB.org/", "http://h.org:80/", "http://x.com#/de/",
    "http://" + "a." * 500 + "org/" + "p/" * 5000, "http://u.com/de/a\nb", "http://u.com/de/a\nb",
    "a://b://c.com/de/",
]


def pages(spark, urls):
    rows = [(i or None, u, "<p>", "h", "r") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule string")


def test_urls_are_judged_as_by_trying_every_rule(spark):
    found = url_rules.judge_pages(pages(spark, URLS), url_rules.rule_table(spark, RULES))
    expected = [(i or None, *plain_judgement(u)) for i, u in enumerate(URLS)]
    assert sorted(map(repr, rows_of(found))) == sorted(map(repr, expected))


def test_short_prefixes_are_confirmed(spark):
    """With one digit most joined pairs are false, and none of them counts."""
    rules = url_rules.rule_table(spark, RULES)
    found = url_rules.judge_pages(pages(spark, URLS), rules, prefix_digits=1)
    assert sorted(map(repr, rows_of(found))) == sorted(repr((i or None, *plain_judgement(u))) for i, u in enumerate(URLS))


def test_no_rules_no_pages_and_no_python(spark):
    rules = url_rules.rule_table(spark, RULES)
    none = spark.createDataFrame([], rules.schema)
    judged = url_rules.judge_pages(pages(spark, URLS), none, default="block")
    assert {r.verdict for r in judged.collect()} == {"block"}
    assert url_rules.judge_pages(pages(spark, URLS).limit(0), rules).count() == 0
    plan = plan_of(url_rules.judge_pages(pages(spark, URLS), rules))
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


ODD_PAGE = """<html><head><title>T &amp; U</title><style>p{}</style></head><body class="page">
<header><h1>Site name here</h1></header><nav><ul><li><a href="/a">Home page of ours</a></ul></nav>
<div class="cookie-notice">We use cookies on all pages of this site</div>
<article><h1>A   &eacute;t&eacute; &lt;story&gt;</h1><p>First <b>bold</b>ly
told<br>words.<aside>Read this other thing too</aside><script>if (a < b) "</p>"</script>
<p>Second &#8220;block&#8221;<div class="advert">Buy now</div><form><input>Your mail</form>
<p>Third.</p><!-- <p>no</p> --><div class="comments"><p>I like this a lot, said a reader</p></div></article>
<div id="sidebar"><p>Popular: more, and more, and more</p></div><footer>&copy; 2026 us and all others</footer>"""


@pytest.fixture(scope="module")
def weights(spark):
    return html_extraction.learn_weights(spark.read.parquet(f"{SAMPLE_FOLDER}/pages.parquet"))


def test_odd_page(weights):
    expected = "A été <story>\nFirst boldly told words.\nSecond “block”\nThird."
    assert html_extraction.extract_text(ODD_PAGE, weights) == expected
    assert html_extraction.extract_text(ODD_PAGE, html_extraction.Weights()) == expected


def test_sample_pages_give_their_articles(spark, weights):
    rows = spark.read.parquet(f"{SAMPLE_FOLDER}/pages.parquet").select("page_id", "html").collect()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.DOTALL)[1]
        parts = re.sub(r"</?(b|br)>", " ", article)
        parts = [html.unescape(p).split() for p in re.split(r"<[^>]*>", parts)]
        expected = "\n".join(" ".join(p) for p in parts if p)
        assert html_extraction.extract_text(r.html, weights) == expected


def test_null_empty_broken_and_long_pages(spark, weights):
    broken = ["", None, "just words", "<p>open <b>tags", "</div></p>text", "<a href=\"x>lost", "&nbsp;", "<", "<!-- x"]
    broken += ["<article><p>" + "word " * 200_000]
    rows = [(i or None, None, h, "t") for i, h in enumerate(broken)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r.page_id: r for r in html_extraction.extract(df.union(df), weights).collect()}
    assert found[None].text == "" and found[1].text == "" and found[2].text == "just words"
    assert found[3].text == "open tags" and found[9].n_chars == 200_000 * 5 - 1
    fixed = html_extraction.learn_weights(df.limit(0))
    assert fixed == html_extraction.Weights() and html_extraction.extract(df.limit(0), fixed).count() == 0


@pytest.mark.parametrize("part", [
    "<a ", '<a href="', "<a '\" ", '<a "x', "<div>", "<div class=ad>", "<section></div>", "<script ", "<", "</", "<!-",
])
def test_long_malformed_pages_take_linear_time(part):
    """Two megabytes; a quadratic scan of any of them would take hours."""
    for end in ("", ">", "'>"):
        begin = time.perf_counter()
        html_extraction.extract_text(part * (2_000_000 // len(part)) + end, html_extraction.Weights())
        assert time.perf_counter() - begin < 40


def test_tag_ends():
    ends = lambda page: [(t.start, t.stop, t.tag, t.end) for t in html_extraction.tokens(page)]
    assert ends("<a href='x>y'>z</a >") == [(0, 14, "a", False), (15, 20, "a", True)]
    # The quote left open ends no tag; the next one is found all the same.
    assert ends("<a href=\"x><b>") == [(11, 14, "b", False)]
    assert ends("a < b <3 <p") == []
    assert ends("<!x><!-- > -->?</>") == [(0, 4, "", False), (4, 14, "", False), (15, 18, "", False)]


def test_best_region():
    assert html_extraction.best_region([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert html_extraction.best_region([-1, -2]) == (0, 0)
    assert html_extraction.best_region([]) == (0, 0)


STORY = "<h1>A title of words</h1>" + "<p>Some words of a long story here.</p>" * 20
NAV = '<nav><a href="/">Home page</a></nav>'
SIDE = '<div class="left-sidebar"><p>Popular: more and more</p></div>'
READERS = '<div id="comments" class="comments-area">%s</div>' % ("<p>I like this story a lot.</p>" * 60)


@pytest.mark.parametrize("named", [
    "class='site-content has-sidebar'", "class='content no-sidebar'", "class='page-content social-share-on'",
    "class='container related-wrapper'", "class='content right-sidebar'", "class=widget", "id='main' class='social'",
])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_of_wrappers_leave_the_text_in(weights, named, tag):
    expected = "A title of words\n" + "\n".join(["Some words of a long story here."] * 20)
    page = f"<body>{NAV}<div {named}><{tag}>{STORY}</{tag}>{SIDE}</div><footer>us</footer></body>"
    for scores in (weights, html_extraction.Weights()):
        assert html_extraction.extract_text(page, scores) == expected


def test_names_still_rule_out_what_is_beside_the_text(weights):
    expected = "A title of words\n" + "\n".join(["Some words of a long story here."] * 20)
    teaser = "<div class='related'><article><p>Read this other story</p></article></div>"
    replies = READERS.replace("<p>", "<article class='comment'><p>").replace("</p>", "</p></article>")
    for beside in (SIDE, READERS, teaser, replies):
        page = f"<body>{NAV}<div class='has-comments'><article>{STORY}</article>{beside}</div></body>"
        assert html_extraction.extract_text(page, weights) == expected
    bare = f"<body>{NAV}<div class='content'>{STORY}</div>{READERS}{SIDE}</body>"
    assert html_extraction.extract_text(bare, weights) == expected


def test_weights_do_not_depend_on_unlabelled_pages(spark):
    """Labelled pages that are one in a hundred teach the same as by themselves; nested ones teach too."""
    page = f"<body>{NAV}<main>{SIDE}<article>{STORY}</article></main></body>"
    rows = [(i, f"http://a.b/{i}", page if i % 100 == 0 else f"<div>{i}</div>") for i in range(2000)]
    every = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = html_extraction.learn_weights(every.where("page_id % 100 = 0"), max_pages=20)
    assert own != html_extraction.Weights()
    assert html_extraction.learn_weights(every, max_pages=20) == own
    # The label is the article, not the main element around it.
    assert own.tag["main"] < own.tag["article"]
