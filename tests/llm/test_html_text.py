"""Extraction from small pages of many shapes."""

import random
import re

import pytest

from feedflow.llm import html_text
from feedflow.llm.html_text import extract, main_text
from tests.llm.conftest import LONG

BODY = "This sentence is long enough to count as running text of an article, and it goes on for a while after that. "

CASES = {
    "article": (f"<nav><a href=x>Home</a></nav><article><h1>Ti&amp;tle</h1><p>{BODY}<p>Short.</article><footer>c</footer>", ["Ti&tle", BODY.strip(), "Short."]),
    "no article": (f"<ul class='menu'><li>A<li>B<li>C</ul><h1>T</h1><p>{BODY}</p><p>End</p><div id=comments><p>{BODY}</div>", ["T", BODY.strip(), "End"]),
    "links": ("<div>" + "<p><a href=x>Go there</a></p>" * 6 + f"</div><p>{BODY}</p>", [BODY.strip()]),
    "in between": (f"<article><p>{BODY}</p><div class='ad box'>Buy</div><p>b<aside>x</aside></p><form><p>y</form><p>c</article>", [BODY.strip(), "b", "c"]),
    "space": (f"<article><p>a\n\t b&nbsp;&nbsp;c<br>d <b>e</b>f &#233; &lt;p&gt;</p><p>{BODY}</article>", ["a b c d ef é <p>", BODY.strip()]),
    "unclosed": (f"<article><h1>T<p><b>{BODY}<p>x", ["T", BODY.strip(), "x"]),
    "script": (f"<script>var a='<p>no</p>'</script><style>p{{}}</style><p>{BODY}<!-- <p>no</p> --><script>never closed <p>no", [BODY.strip()]),
    "hidden": (f"<p hidden>no</p><p style='display: none'>no</p><p>{BODY}", [BODY.strip()]),
    "menu in an article": (f"<article><nav><a href=x>Home</a> and more</nav></article><div><p>{BODY}</p></div>", [BODY.strip()]),
    "page in a form": (f"<body><form action=x><h1>T</h1><p>{BODY}</p><ul class=menu><li>m</ul></form></body>", ["T", BODY.strip()]),
    "a form only": ("<body><form><p>Your name</p><button>Go</button></form></body>", []),
    "less than": (f"<p>1 < 2 and 3 <4 <p>{BODY}", ["1 < 2 and 3 <4", BODY.strip()]),
    "broken quote": (f"<p title=\"never closed>{BODY}</p><p>z</p>", [BODY.strip(), "z"]),
    "attributes": (f"<p title='a > b'>{BODY}</p><p data-x=\"</p>\">z</p>", [BODY.strip(), "z"]),
    "plain": ("just text", ["just text"]),
    "short": ("<article><p>Hi.</article>", ["Hi."]),
    "empty": ("", []),
}


@pytest.mark.parametrize("name", list(CASES))
def test_case(name):
    page, blocks = CASES[name]
    assert main_text(page) == "\n\n".join(blocks)


def test_table(spark):
    rows = [(1, "u", CASES["article"][0], "t"), (2, None, None, None), (3, "u", "", None), (3, "u", "", None), (4, "u", f"<p>{LONG}</p>", None), (None, None, "<p>x", None)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(found) == 6
    by_id = {r["page_id"]: r for r in found}
    assert by_id[2]["text"] == "" and by_id[2]["n_chars"] == 0 and by_id[4]["text"] == LONG.strip() and by_id[None]["text"] == "x"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).isEmpty()


def test_marks_do_not_decide_over_a_surge():
    main = "Sentence of the main text. " * 20
    page = f"<body><div class=story><p>{main}</p><p>{main}end</p></div><hr><article><h2>x</h2><p>Teaser of about forty characters, ok</p></article>"
    assert main.strip() in main_text(page) and main + "end" in main_text(page)
    lines = "".join(f"<p>{main}{i}</p>" for i in range(3))
    between = main_text(f"<body><article><p>{main}a</p></article>{lines}<article><p>{main}b</p></article>")
    assert between.split("\n\n") == [main + str(i) for i in ("a", 0, 1, 2, "b")]


@pytest.mark.parametrize("piece", ["<a ", "<b", '<p title="', "<svg>", "</svg ", "<!", "<!-- ", "<a '> '", "<p class='x", "< "])
def test_broken_pages_take_linear_time(piece):
    import time

    for tail in ("", ">"):
        page = piece * (5_000_000 // len(piece)) + tail
        started = time.process_time()
        main_text(page)
        assert time.process_time() - started < 20


MAIN = "Sentence of the main text, which is told at some length here. " * 4
STRUCTURE = {
    "teasers as articles": (f"<div class=story><h1>T</h1><p>{MAIN}</p><p>{MAIN}</p></div>" + "<article><h2>Card</h2><p>Read on</p></article>" * 4, ["T", MAIN.strip(), MAIN.strip()]),
    "a menu of plain blocks": (f"<div>Home</div><div>About us</div><div>Contact</div><div><div><h1>T</h1><p>{MAIN}</p></div></div>", ["T", MAIN.strip()]),
    "plain footer": (f"<div><h1>T</h1><p>{MAIN}<p>End.</div><div>(c) A company, all rights</div>", ["T", MAIN.strip(), "End."]),
    "sections": ("".join(f"<div><div><h2>Part {i}</h2><p>{MAIN}{i}</p></div></div>" for i in range(3)), [t for i in range(3) for t in (f"Part {i}", f"{MAIN}{i}")]),
    "a short paragraph between wrapped ones": (f"<div><p>{MAIN}</p></div><div><p>Yes.</p></div><div><p>{MAIN}</p></div><div><p>Log in</p></div>", [MAIN.strip(), "Yes.", MAIN.strip()]),
    "an advert between marked articles": (f"<article><p>{MAIN}</p></article><div>Buy one now</div><article><p>{MAIN}</p></article>", [MAIN.strip(), MAIN.strip()]),
}


@pytest.mark.parametrize("name", list(STRUCTURE))
def test_windows_decide_where_nothing_is_marked(name):
    page, blocks = STRUCTURE[name]
    assert main_text(page) == "\n\n".join(blocks)


def neutral(page):
    """The page without any mark: its parts are plain blocks without class, id or role."""
    page = re.sub(r"<(/?)(article|nav|footer|aside|main|header|section)\b", r"<\1div", page)
    return re.sub(r"\s(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)


def test_pages_keep_their_text_with_their_marks_neutral(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]
    assert len(pages) == 2500 and all("<article>" in page for page in pages)
    kept = sum(main_text(neutral(page)) == main_text(page) for page in pages)
    assert kept >= 0.9 * len(pages)


def brute_stretches(lengths, inside):
    """Lines of text belong together unless a window of blanks lies between; every window is summed anew."""
    window = html_text.WINDOW
    rows = [i for i, n in enumerate(lengths) if n]
    groups = []
    for i in rows:
        if groups and i - groups[-1][-1] <= window:
            groups[-1].append(i)
        else:
            groups.append([i])
    height = lambda g: max(sum(lengths[j] for j in g if i <= j < i + window) for i in g) * (html_text.WEIGHT if any(inside[i] for i in g) else 1)
    highest = min(max(map(height, groups), default=0), html_text.LONG)
    up = [g for g in groups if height(g) > html_text.SURGE and height(g) >= highest / html_text.PART]
    if not up:
        groups.sort(key=lambda g: (not any(inside[i] for i in g), -sum(lengths[i] for i in g), g[0]))
        return set(groups[0]) if groups else set()
    kept = {i for g in up for i in g}
    for a, b in zip(up, up[1:], strict=False):
        # From the last window with text to the first one of the next surge.
        between = b[0] - window + 1 - (a[-1] + 1)
        kinds = {inside[i] for i in range(a[-1] + 1, max(a[-1] + 1, b[0] - window + 1))} | {any(inside[i] for i in g) for g in (a, b)}
        if between <= html_text.BRIDGE and len(kinds) == 1:
            kept |= {i for i in rows if a[-1] < i < b[0]}
    return kept


def test_stretches_equal_windows_summed_anew():
    rng = random.Random(5)
    for _ in range(3000):
        lengths = [rng.choice([0, 0, 0, 3, 30, 60, 90, 200, 700]) for _ in range(rng.randrange(0, 60))]
        inside, own = [], False
        for i in range(len(lengths)):
            # Articles are apart from the rest by a window of blanks, as in kept_text.
            if i >= 2 and not lengths[i - 1] and not lengths[i - 2] and rng.random() < 0.2:
                own = not own
            inside.append(own)
        found = {i for a, b in html_text.stretches(lengths, inside) for i in range(a, b) if lengths[i]}
        assert found == brute_stretches(lengths, inside), (lengths, inside)
