from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from meterline.llm.html_text import extract_article, main_text

LONG = "A sentence, long enough, that counts as a paragraph of the text."
PAGES = {
    "article among other parts": (
        f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><a href=1>Home</a></nav>"
        f"<header><h1>Site</h1></header><main><article><header><h1>Title</h1></header><p>{LONG}</p><aside>side</aside>"
        f"<form><p>{LONG}</p></form><p>Tom &amp; Anna&nbsp;&lt;3<br>next\n line</p><section class='comments'><p>{LONG}</p></section>"
        f"</article></main><footer>f</footer></body></html>",
        f"Title\n\n{LONG}\n\nTom & Anna <3 next line",
    ),
    "scored container, no article": (
        f"<body><div id=menu><ul><li><a href=1>a</a><li><a href=2>b</a></ul></div><div class='cookie-notice'>{LONG}</div>"
        f"<div class=box><h1>T</h1><p>{LONG}<p>Second <b>one, {LONG}</div><div class=sidebar><p>{LONG}{LONG}</p></div></body>",
        f"T\n\n{LONG}\n\nSecond one, {LONG}",
    ),
    "left open": (f"<article><h1>H</h1><p><b>{LONG}<br><p>{LONG}", f"H\n\n{LONG}\n\n{LONG}"),
    "cut in a tag": (f"<article><p>{LONG}</p><p cla", LONG),
    "cut in a reference": (f"<article><p>{LONG} R&am", f"{LONG} R&am"),
    "advert and hidden": (
        f"<article><p>{LONG}</p><div class='ad'>Buy</div><div hidden>x</div><p style='display:none'>y</p><div aria-hidden=true>z</div></article>",
        LONG,
    ),
    "list of links in the text": (
        f"<article><p>{LONG}</p><ul><li><a href=1>one more</a><li><a href=2>and another</a></ul><ul><li>kept item</li></ul></article>",
        f"{LONG}\n\nkept item",
    ),
    "nothing": ("", ""),
    "no text": ("<html><body><script>x</script></body></html>", ""),
    "comment only": ("<!-- a <p>b</p> -->", ""),
    "plain text": ("just words", "just words"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, text = PAGES[name]
    assert main_text(page) == text


def test_siblings_of_the_best_container_stay():
    long, short = ", ".join(["word" * 12] * 6), ", ".join(["text" * 25] * 2)
    page = (
        f"<body><div id=content>Bare text before<section>{f'<p>{long}</p>' * 10}</section> bare <a href=1>text</a> after it all"
        f"<section>{f'<p>{short}</p>' * 2}</section><div>A short line.</div><div></div>"
        f"<div><a href=1>one more page</a> <a href=2>and another page</a></div></div></body>"
    )
    blocks = ["Bare text before", *[long] * 10, "bare text after it all", *[short] * 2, "A short line."]
    assert main_text(page) == "\n\n".join(blocks)


WHOLE = {
    "two articles in main": (f"<main><article><p>{LONG} A</p></article><article><p>{LONG} B</p></article></main>", [f"{LONG} A", f"{LONG} B"]),
    "two articles in the body": (
        f"<body><nav>n</nav><article><p>{LONG} A</p><p>{LONG}</p></article><div>Adrift</div><article><p>{LONG} B</p></article></body>",
        [f"{LONG} A", LONG, f"{LONG} B"],
    ),
    "title beside the article": (f"<main><h1>Title</h1><article><p>{LONG}</p></article></main>", ["Title", LONG]),
    "title beside the article, no main": (
        f"<body><div><h1>Title</h1><article><p>{LONG}</p></article><h2>More</h2></div></body>", ["Title", LONG]
    ),
    "text beside the parent": (
        f"<body><div><h1>Title</h1><p>Intro, short.</p><div><div>{f'<p>{LONG}</p>' * 4}</div></div><p>Last.</p></div></body>",
        ["Title", "Intro, short.", *[LONG] * 4, "Last."],
    ),
    "references": (
        f"<article><p>{LONG}</p><h2>References</h2><ul><li><a href=1>One 2001</a><li><a href=2>Two 2002</a></ul></article>",
        [LONG, "References", "One 2001", "Two 2002"],
    ),
    "long references": (
        f"<article><p>{LONG}</p><ul><li><a href=1>{LONG}</a><li><a href=2>{LONG}</a></ul></article>", [LONG] * 3
    ),
    "related links": (
        f"<article><p>{LONG}</p><h2>Related</h2><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></article>", [LONG, "Related"]
    ),
    "a form around the page": (f"<body><form><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></form></body>", ["Title", LONG, LONG]),
    "a form around all but the title": (f"<body><h1>T</h1><form><p>{LONG}</p></form></body>", ["T", LONG]),
    "a form beside the text": (f"<body><div><h1>T</h1><p>{LONG}</p></div><form><p>{LONG}</p></form></body>", ["T", LONG]),
    "a name that holds a word of the list": (
        f"<article><p>{LONG}</p><div class='share-holders'><p>{LONG}</p></div><div class='share-buttons'><p>{LONG}</p></div></article>",
        [LONG, LONG],
    ),
    "a frame named after its sidebar": (
        f"<body><div class='sidebar-left'><h1>T</h1><p>{LONG}</p><p>{LONG}</p><div class=sidebar><p>{LONG}</p></div></div></body>",
        ["T", LONG, LONG],
    ),
    "comments longer than the text": (
        f"<article><p>{LONG}</p><div class='comments'><h1>Comments</h1>{f'<p>{LONG}</p>' * 9}</div></article>", [LONG]
    ),
    "a notice longer than the text": (f"<body><article><p>{LONG}</p></article><div class='cookie-notice'>{LONG * 9}</div></body>", [LONG]),
    "a part cut off ends a block": (f"<article>{LONG}<div class=ad>Buy</div>after</article>", [LONG, "after"]),
}


@pytest.mark.parametrize("name", WHOLE)
def test_no_article_text_is_lost(name):
    page, blocks = WHOLE[name]
    assert main_text(page) == "\n\n".join(blocks)


@pytest.mark.parametrize("seed", range(20))
def test_generated_pages_equal_what_they_were_made_of(seed):
    """Pages from a random outline; what belongs to the article is known as they are made."""
    rng = random.Random(seed)
    expected: list[str] = []

    def words(least):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(rng.randint(least, least + 40)))

    def own(depth):
        kind = rng.choice(["p", "p", "h2", "list", "quote", "nest", "bold"] if depth < 4 else ["p"])
        if kind == "nest":
            tag = rng.choice(["div", "section"])
            return f"<{tag}>{''.join(piece(depth + 1) for _ in range(rng.randint(1, 4)))}</{tag}>"
        if kind == "list":
            items = [words(3) for _ in range(3)]
            expected.extend(items)
            return "<ul>" + "".join(f"<li>{item}" for item in items) + "</ul>"
        text = words(8)
        expected.append(f"{text} & more")
        tags = {"p": ("<p>", "</p>"), "h2": ("<h2>", "</h2>"), "quote": ("<blockquote>", "</blockquote>"), "bold": ("<p><b>", "</b></p>")}
        start, end = tags[kind]
        return f"{start}{text}\n &amp;  more{end}"

    def other():
        text = words(5)
        return rng.choice([
            f"<aside><p>{text}</p></aside>", f"<div class='ad-box'>{text}</div>", f"<form><label>{text}</label></form>",
            f"<div id=newsletter><p>{text}</p></div>", f"<section class=comments><p>{text}</p></section>",
            f"<nav><a href=1>{text}</a></nav>", f"<!-- {text} -->", f"<script>'{text}'</script>",
        ])

    def piece(depth):
        return own(depth) + (other() if rng.random() < 0.3 else "")

    around = rng.choice([("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div><div>", "</div></div>")])
    text = "".join(piece(0) for _ in range(rng.randint(6, 20)))
    page = f"<html><body><header>{words(3)}</header>{other()}{around[0]}{text}{around[1]}{other()}<footer>{words(3)}</footer></body></html>"
    assert main_text(page) == "\n\n".join(expected)


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert main_text(deep) == LONG
    many = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert main_text(many).count("\n\n") == 19_999


def test_rows(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", None), (None, None, "<p>é, x"), (2, "v", ""), (3, "w", "<p>dup"), (3, "w", "<p>dup")]
    frame = spark.createDataFrame(rows, schema).withColumns({"text": F.lit(1), "page": F.lit(2)})
    found = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in extract_article(frame).collect())
    assert found == [("1", "u", "", 0), ("2", "v", "", 0), ("3", "w", "dup", 3), ("3", "w", "dup", 3), ("None", None, "é, x", 4)]
    assert extract_article(spark.createDataFrame([], schema)).collect() == []
