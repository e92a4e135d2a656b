import math
import random
import time

import pytest
from helpers import empty, rows_of

from ledgerlane.llm.html_text import COUNTED, TreeBuilder, _in_order, _measure, extract_text, main_text

NAV = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">About us</a></ul></nav>'
PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("  \n", ""),
        ("just words", "just words"),
        ("<p>a<p>b", "a\nb"),
        (f"<html><body>{NAV}<article><h1>T &amp; U</h1><p><b>One.<br><p>Two\n  three</article><footer>&copy; x</footer>", "T & U\nOne.\nTwo three"),
        (f"{NAV}<div class='ad'>Buy this now, really, it is such a long advert that it is the longest text here.</div><div><h2>Title</h2><p>Words of the page.</p></div>", "Title\nWords of the page."),
        ("<article><p>x</p><script>var a='</p>';</script><style>p{}</style><p>y&eacute;&#x41;</p></article>", "x\nyéA"),
        ("<article><header><h1>Kept</h1></header><p>Body</p><section id='comments'><p>Nice post, I like it very much indeed.</p></section></article>", "Kept\nBody"),
        ("<div id='header'>Top</div><main><p>One</p><aside>side</aside><form><p>Your name</p></form><p>Two</p></main>", "One\nTwo"),
        ("<div class='menu-open content'><article><p>Still here</p></article></div>", "Still here"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul></article>", "a\nb\nc\nd\ne"),
        ("<article><p>a <i>b</i><b>c</b> d</p></article>", "a bc d"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<script>never closed <p>x</p>", ""),
        ("<p>a</b></div></p>b", "a\nb"),
    ],
)
def test_text_of_a_page(html, text):
    assert main_text(html or "") == text


STORY = "".join(f"<p>Sentence {i} of the story, which has quite a number of words in it, as stories do.</p>" for i in range(8))
STORY_TEXT = "\n".join(f"Sentence {i} of the story, which has quite a number of words in it, as stories do." for i in range(8))
SIDE = "<div class='{}'><p>Read this too, if you like it.</p></div>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id='aspnetForm'>{NAV}<div>{STORY}</div><div class='footer'>c x</div></form></body>",
        f"<body><form id='aspnetForm'><article>{STORY}</article></form></body>",
        f"<body><div id='content' class='no-sidebar'>{STORY}</div>{NAV}</body>",
        f"<body><div class='post comments-open'>{STORY}</div></body>",
        f"<body><div class='social-study'>{STORY}</div><p>Next.</p></body>",
        f"<body><div class='page-with-sidebar'><div class='newsletter-archive'>{STORY}</div>{SIDE.format('sidebar')}</div></body>",
        f"<body><div class='overlay'><form>{STORY}<p class='subscribe'>Your address, please</p></form></div></body>",
        f"<body><section id='menu'>{STORY}</section><footer><p>{'Legal words without end. ' * 9}</p></footer></body>",
    ],
)
def test_elements_that_hold_the_article_stay(page):
    assert main_text(page) in (STORY_TEXT, STORY_TEXT + "\nNext.")


@pytest.mark.parametrize("name", ["sidebar", "ad-banner", "cookie notice", "related-posts", "comment-list"])
def test_short_named_blocks_go(name):
    assert main_text(f"<body><div class='story'>{STORY}</div>{SIDE.format(name)}</body>") == STORY_TEXT
    assert main_text(f"<body><div class='story'>{STORY}{SIDE.format(name)}</div></body>") == STORY_TEXT


def test_long_comments_go_and_pages_without_an_article_are_empty():
    comments = "".join(f"<p>Reader {i} says that this is a good story, but a bit too short.</p>" for i in range(20))
    assert main_text(f"<body><div>{STORY}</div><div class='comments'>{comments}</div></body>") == STORY_TEXT
    assert main_text(f"<body>{NAV}<footer><p>{'Legal words. ' * 30}</p></footer></body>") == ""
    assert main_text("<body><form><p>Your name</p></form><div class='cookie'>We use cookies.</div></body>") == ""


def _random_tree(pick, depth=0):
    tag = pick.choice(["div", "p", "span", "a", "ul", "b"])
    inner = "".join(pick.choice(["word ", "two words "]) * pick.randrange(9) if pick.random() < 0.5 or depth > 4 else _random_tree(pick, depth + 1) for _ in range(pick.randrange(4)))
    return f"<{tag}>{inner}</{tag}>"


def _densities(node):
    """(characters, tags, characters of links, tags of links) below a node, counted afresh."""
    chars = len("".join(node.text.split()))
    tags = link_chars = link_tags = 0
    for child in node.children:
        c, t, lc, lt = _densities(child)
        chars, tags, link_chars, link_tags = chars + c, tags + t + (child.tag in COUNTED), link_chars + lc, link_tags + lt
    return (chars, tags, chars, link_tags + 1) if node.tag == "a" else (chars, tags, link_chars, link_tags)


@pytest.mark.parametrize("seed", range(25))
def test_densities_of_random_trees(seed):
    builder = TreeBuilder()
    builder.feed("".join(_random_tree(random.Random(seed * 100 + k)) for k in range(6)))
    builder.close()
    nodes = _in_order(builder.root)
    _measure(nodes)
    whole = _densities(nodes[0])
    share = whole[2] / max(whole[0], 1)
    for node in nodes:
        chars, tags, links, link_tags = _densities(node)
        assert (node.chars, node.tags, node.link_chars, node.link_tags) == (chars, tags, links, link_tags)
        weight = 1.0
        if share:
            ratio = chars / max(links, 1) * max(tags, 1) / max(link_tags, 1)
            base = math.log(chars / max(chars - links, 1) * links + share * chars + math.e)
            weight = math.log(max(ratio, 1.0)) / math.log(max(base, 1.001))
        assert node.density == pytest.approx(chars / max(tags, 1) * weight)
        assert node.total == pytest.approx(sum(child.density for child in node.children))


def test_link_lists_are_less_dense_than_text():
    links = "".join(f"<li><a href='/{i}'>A rather long title of another story {i}</a></li>" for i in range(30))
    story = "".join(f"<p>Sentence {i} of the story, which has a number of words in it.</p>" for i in range(6))
    assert main_text(f"<body><div><ul>{links}</ul></div><div>{story}</div></body>").startswith("Sentence 0")
    assert "another story" not in main_text(f"<body><div><ul>{links}</ul></div><div>{story}</div></body>")


def test_deep_wide_and_broken_pages_take_linear_time():
    started = time.time()
    assert main_text("<article>" + "<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert main_text("<body>" + "<p>x y</p>" * 20_000).count("\n") == 19_999
    assert len(main_text("<article><p>" + "word " * 200_000)) == 999_999
    main_text("<a" * 10_000)
    main_text("<!--" * 10_000)
    assert time.time() - started < 20


def test_awkward_rows(spark):
    rows = [(1, "u", "<p>é b</p>"), (2, None, None), (None, "v", ""), (1, "u", "<p>é b</p>")]
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], PAGES + ", text string, n_chars int")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert rows_of(found, "*") == sorted(
        [(1, "u", "é b", 3), (1, "u", "é b", 3), (2, None, "", 0), (None, "v", "", 0)], key=repr
    )
    assert extract_text(empty(spark, PAGES)).collect() == []


def test_very_long_pages_and_an_empty_table(spark):
    html = "<body><article>" + "".join(f"<p>Paragraph {i} of a page that goes on and on.</p>" for i in range(30_000)) + "</article></body>"
    found = extract_text(spark.createDataFrame([(1, "u", html)], PAGES)).first()
    assert found["text"].count("\n") == 29_999 and found["n_chars"] == len(found["text"])
    assert extract_text(empty(spark, PAGES)).count() == 0
