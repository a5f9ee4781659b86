"""Main text of pages: built pages with every kind of non-content, broken markup, awkward rows."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm.html_text import extract_pages, main_text

NOISE = [
    "<nav><ul><li><a href=/a>Menu one</a><li><a href=/b>Menu two</a></ul></nav>",
    "<header><h1>Site name</h1><p>The site's motto</p></header>",
    "<footer>&copy; someone, all rights reserved, and some words more to make it long</footer>",
    "<aside><p>A sidebar paragraph that is long enough to look like an article paragraph to a careless reader.</p></aside>",
    "<div class='ad'>Buy this now, the best there ever was, at half its price and free of charge.</div>",
    "<div id=\"cookie-notice\" role=alert>We use cookies to make your visit better. <button>Accept all</button></div>",
    "<form action=/s><label>Name</label><input name=q value=x><textarea>typed</textarea><select><option>one<option>two</select></form>",
    "<script>var t='</p>'; if (a<b) document.write('<p>no</p>');</script>",
    "<style>p > a { color: red }</style><noscript><p>Enable scripts</p></noscript>",
    "<section class='comments'><article class=comment><p>First! I think that this is a long reader comment, longer than many a paragraph.</p></article></section>",
    "<!-- <p>commented out</p> -->", "<p hidden>not shown</p>", "<div style='display: none'>nor this</div>",
    "<ul class=\"social share\"><li><a href=#>Share</a></ul>", "<svg><title>icon</title><text>logo</text></svg>",
]
WORDS = "river stone under light carry seven green again morning small <b>bold</b> <a\nhref=/x>linked</a> caf&eacute; R&amp;D 5&nbsp;&lt;&nbsp;6".split(" ")
PLAIN = "river stone under light carry seven green again morning small bold linked café R&D".split() + ["5 < 6"]


def block(rng):
    picks = [rng.randrange(len(WORDS)) for _ in range(rng.choice([1, 3, 20, 90]))]
    gap = rng.choice([" ", "\n  ", "\t", "<br>", "<br/> "])
    return gap.join(WORDS[i] for i in picks), " ".join(PLAIN[i] for i in picks)


def page(seed, tag):
    rng = random.Random(seed)
    inside, wanted = [], []
    for k in range(rng.randint(1, 12)):
        html, text = block(rng)
        name = "h1" if k == 0 else rng.choice(["p", "p", "p", "h2", "blockquote", "li"])
        inside.append(f"<{name}>{html}</{name}>" if name != "p" or rng.random() < 0.7 else f"<p>{html}")
        wanted.append(text)
        if rng.random() < 0.3:
            inside.append(rng.choice([n for n in NOISE if not n.startswith("<header")]))
    around = [rng.choice(NOISE) for _ in range(8)]
    html = (f"<!DOCTYPE html><html><head><meta charset=utf-8><title>t</title></head><body class='has-sidebar'>{''.join(around[:4])}"
            f"<{tag}>{''.join(inside)}</{tag.split()[0]}>{''.join(around[4:])}</body></html>")
    return html, "\n".join(wanted)


@pytest.mark.parametrize("tag", ["article", "main", "article class='post'"])
def test_built_pages(tag):
    for seed in range(150):
        html, wanted = page(seed, tag)
        assert main_text(html) == wanted


def test_pages_without_semantic_elements():
    long = "This is a sentence of the text, and there are many of them in a row. " * 4
    menu = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(12))
    html = (f"<body><div>{menu}</div><div><h2>Title</h2><div>{long}</div><div>Short.</div><div>{long}</div><div>{long}</div></div>"
            f"<div><span>Contact</span> <a href=/>Home</a></div></body>")
    text = long.strip()
    assert main_text(html) == "\n".join(["Title", text, "Short.", text, text])
    assert main_text(f"<p>{long}<p>Short.<p>{long}") == f"{text}\nShort.\n{text}"


def test_several_articles_and_headers_of_articles():
    long = "words of a story that goes on for a while " * 5
    html = f"<body><article><header><h2>One</h2><p>by me</p></header><p>{long}</article><article><p>{long}</p><footer>tags</footer></article>"
    assert main_text(html) == f"One\n{long.strip()}\n{long.strip()}"
    assert main_text(f"<form runat=server><nav>n</nav><article><p>{long}</article></form>") == long.strip()


@pytest.mark.parametrize("html,wanted", [
    ("", ""), ("plain words", "plain words"), ("<p>", ""), ("<script>x", ""), ("<article></article>", ""),
    ("<article><p>a<b>b<p>c</i></div></article>tail", "ab\nc"), ("<p>1 < 2 &amp;& &#x41;&#0;&unknown; &copy", "1 < 2 && A�&unknown; ©"),
    ("<![CDATA[x]]><p>a</p><!bogus><?pi?><![if x]>", "a"),
    ("<nav>only a menu</nav>", ""), ("<div class=ad>only an advert</div><article></article>", ""),
])
def test_broken_markup(html, wanted):
    assert main_text(html) == wanted


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "</", "<p>", "</p>", "<div class=ad>", "</div>", "<article>", "</article>", "<!--", "-->",
                                 "<![", "<!", "&", "&#", "x", " ", "word ", "<a href='", "'", "<script>", "</script>", "<li>", "<td>",
                                 "</table>", "<body>", "\x00", "é"]), max_size=40).map("".join))
def test_any_markup_is_read(html):
    text = main_text(html)
    assert text == "\n".join(" ".join(x.split()) for x in text.split("\n"))


def test_very_long_and_deep_pages():
    n = 30_000
    assert main_text("<article>" + "<p>w " * n + "</article>").count("\n") == n - 1
    for deep in ("<div>" * n + "text" + "</div>" * n, "<b>" * n + "text" + "</i>" * n, "<li>" * n + "text", "<ul><li>" * n + "text" + "</b>" * n):
        assert main_text(deep) == "text"


def test_awkward_rows(spark):
    rows = [(1, "u", None, 5), (2, None, "", 6), (3, "u", "<p>a b</p>", None), (3, "u", "<p>a b</p>", None), (None, "v", "<p>c", 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, TEXT int")
    got = extract_pages(df.withColumnRenamed("TEXT", "n_chars")).collect()
    assert sorted((str(r.page_id), str(r.n_chars), r.text) for r in got) == [
        ("1", "5", ""), ("2", "6", ""), ("3", "None", "a b"), ("3", "None", "a b"), ("None", "1", "c")]
    assert extract_pages(df, out_col="html").select("html").collect()[2].html == "a b"
    assert extract_pages(df.limit(0)).count() == 0
