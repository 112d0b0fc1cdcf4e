import collections
import random

import pytest

from pulse.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head>
<body class="has-sidebar"><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div id="cookie-notice">We, use, cookies.</div>
<div class="layout with-sidebar"><article><header><h1>Head&amp;line</h1><span>by us</span></header>
<p><b>First,   with
 white&nbsp;space<br>and a break<p>Second &lt;para&gt; &#233;<ul><li>one<li>two</ul><form><input><p>Search</p></form>
<div class="ad">Buy, buy, buy</div><p style="display: none">hidden</p></article>
<div class="sidebar"><p>Side, side, side, side, side, side</p></div>
<section id="comments"><article class="comment"><p>Nice, very nice, so nice, and long too</p></article></section></div>
<footer>&copy; site</footer>"""


def test_article_without_surroundings():
    assert main_text(PAGE) == ("Head&line\n\nFirst, with white space and a break\n\nSecond <para> é\n\none\n\ntwo")


@pytest.mark.parametrize("page, text", [
    ("<p>a, b</p><div class='cookieNotice'><p>We, use</p></div><div id=SiteFooter>end</div>", "a, b"),
    (None, ""), ("", ""), (" \n", ""), ("<script>x</script>", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b", "a\n\nb"), ("<div>a<div>b</div>c</div>", "a\n\nb\n\nc"), ("<p>cut off &am", "cut off &am"),
    ("<p>kept</p><p cla", "kept"), ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<p>1 < 2</p>", "1 < 2"),
    ("</div></p><p>stray ends</p>", "stray ends"), ("<article></article>", ""),
    ("<body><div><p>Text, of, the, page.</p></div><div><a href=x>link</a> <a href=y>link</a></div></body>",
     "Text, of, the, page."),
])
def test_small_pages(page, text):
    assert main_text(page) == text


TEXT = "Text, of, the, page, in, a, sentence, of, some, length."


@pytest.mark.parametrize("page, text", [
    (f"<body><form id=aspnetForm><nav>menu</nav><input name=q><select><option>x</select><article><h1>Head</h1><p>{TEXT}</p>"
     "<button>Send</button></article></form></body>", f"Head\n\n{TEXT}"),
    (f"<body><form><div><main><p>{TEXT}</p></main></div></form>", TEXT),
    (f"<body><form><div><h1>Head</h1><p>{TEXT}</p><textarea>a</textarea></div></form>", f"Head\n\n{TEXT}"),
    (f"<body><form action=x><div class=content><p>{TEXT}</p><p>{TEXT}</p></div></form><footer>end</footer>", f"{TEXT}\n\n{TEXT}"),
    (f"<body><aside><main><p>{TEXT}</p></main></aside>", TEXT),
    (f"<body><article><p>{TEXT}</p><form><h1>Letter</h1><p>Sign up</p></form></article>", TEXT),
    (f"<body><article><p>{TEXT}</p></article><form><p>Sign up</p></form>", TEXT),
    (f'<p><svg class="icon"/>{TEXT}</p><p>b</p>', f"{TEXT}\n\nb"), ("<p>a <math /> b</p><p>c</p>", "a b\n\nc"),
    ("<p>a <svg><text>no</text></svg> b</p>", "a b"), ("<p>a<script src=x />b</p>", "a"),
])
def test_wrapping_forms_and_self_closed_elements(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 5000 + "<p>deep</p>") == "deep"
    words = " ".join(f"w{i}" for i in range(200_000))
    assert main_text(f"<article><p>{words}</p></article>") == words


def test_frame_with_clashing_columns(spark):
    rows = [(1, "<p>a</p>", "old"), (1, "<p>a</p>", "old"), (2, None, None), (None, "", "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = extract(df).select("page_id", "text", "n_chars").collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == [(1, "a", "old"), (1, "a", "old"), (2, "", None)]
    assert extract(df.limit(0)).count() == 0


LONG = "A paragraph of the article, long enough to be running text, which no list of words should take away."


@pytest.mark.parametrize("page, text", [
    (f'<article><p>{TEXT}</p><section id="market-share"><h2>Share</h2><p>{LONG}</p></section></article>',
     f"{TEXT}\n\nShare\n\n{LONG}"),
    (f'<article><p>{TEXT}</p><div class="side-by-side"><p>{LONG}</p></div></article>', f"{TEXT}\n\n{LONG}"),
    (f'<body><div class="recipe-menu"><p>{LONG}</p><p>{LONG}</p></div><p>short.</p>', f"{LONG}\n\n{LONG}\n\nshort."),
    (f'<article><p>{TEXT}</p><div class="share-bar"><p><a href=x>{LONG}</a></p></div></article>', TEXT),
    (f'<article><p>{TEXT}</p><div class="share"><p>{LONG}</p></div></article>', TEXT),
    (f'<article><p>{TEXT}</p><p>{LONG}</p></article><div class="side-column"><p>{LONG}</p></div>', f"{TEXT}\n\n{LONG}"),
])
def test_weak_names_are_weighed(page, text):
    assert main_text(page) == text


def generated(rng):
    """(page, blocks of its article): an article among menus, sidebars, adverts, notices, forms and comments."""
    words = ["alpha", "beta", "gamma", "delta", "market", "share", "menu", "value", "a&amp;b", "caf&eacute;", "x &lt; y"]
    plain = {"a&amp;b": "a&b", "caf&eacute;": "café", "x &lt; y": "x < y"}
    blocks, inside = [], []

    def sentence(n, tag, attributes=""):
        picked = rng.choices(words, k=n)
        blocks.append(" ".join(plain.get(w, w) for w in picked) + ", end.")
        inside.append(f"<{tag}{attributes}>" + rng.choice([" ", "\n", "  "]).join(picked) + f", end.</{tag}>")

    sentence(5, "h1")
    for _ in range(rng.randint(2, 7)):
        sentence(rng.randint(12, 60), rng.choice(["p", "p", "p", "blockquote"]), rng.choice(["", ' class="text"', ' id="market-share"']))
        if rng.random() < 0.3:
            inside.append("<div class='ad'><p>Buy now, buy cheap, buy all of it today, friends.</p></div>")
        if rng.random() < 0.2:
            inside.append("<ul>")
            for _ in range(3):
                sentence(4, "li")
            inside.append("</ul>")
        if rng.random() < 0.2:
            inside.append("<script>var p = '<p>no</p>';</script><!-- <p>nor this</p> -->")
    body = "".join(inside)
    shell = rng.choice([f"<article>{body}</article>", f"<main><div class='content'>{body}</div></main>",
                        f"<div id='page-content'><div class='entry'>{body}</div></div>", f"<section class='post'>{body}</section>"])
    link = lambda: f"<a href='/{rng.random()}'>{rng.choice(words)} {rng.choice(words)}</a>"
    menu = "<nav><ul>" + "".join(f"<li>{link()}</li>" for _ in range(8)) + "</ul></nav>"
    side = rng.choice(["<aside><p>Side story, with commas, many of them, and a link</p></aside>",
                       "<div class='sidebar'><p>Side story, with commas, many of them, indeed, a lot</p></div>",
                       f"<div class='related-posts'><p>{link()}</p><p>{link()}</p></div>"])
    end = rng.choice(["<footer><p>All rights, of all, reserved.</p></footer>", "<div id='site-footer'>Imprint, contact</div>"])
    talk = rng.choice(["", "<section id='comments'><div class='comment'><p>I liked it, really, a lot, yes, thanks</p></div></section>"])
    form = rng.choice(["", "<form><p>Your name, please</p><input><button>Send</button></form>"])
    notice = rng.choice(["", "<div class='cookie-notice'><p>We use cookies, as all do, for you.</p></div>"])
    return (f"<html><head><title>t</title></head><body>{notice}<header><p>Site, name</p></header>{menu}"
            f"<div class='wrap'>{shell}{side}</div>{talk}{form}{end}</body></html>", blocks)


def test_generated_pages_precision_and_recall(spark):
    rng = random.Random(5)
    pages = [generated(rng) for _ in range(400)]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "page_id int, html string")
    right = found = there = exact = 0
    for r in extract(df).collect():
        want, got = (collections.Counter(t.split()) for t in (" ".join(pages[r["page_id"]][1]), r["text"]))
        right, found, there = right + sum((want & got).values()), found + sum(got.values()), there + sum(want.values())
        exact += r["text"] == "\n\n".join(pages[r["page_id"]][1])
    assert right / there >= 0.995 and right / found >= 0.98 and exact >= 0.9 * len(pages), (right / there, right / found, exact)
