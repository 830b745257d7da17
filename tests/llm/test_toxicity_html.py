"""Held-out accuracy of the toxicity score; main text of pages."""

from __future__ import annotations

import math
import random
import time
import zlib
from collections import Counter

import pytest

from mailsift.llm import queries as catalog
from mailsift.llm import html_extract, toxicity
from mailsift.llm.html_extract import extract, main_text
from tests.llm.helpers import clashing, docs

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(12)
    plain = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    nasty = ["vilefool", "muckhead", "dregs"]
    rows, labels = [], []
    for n in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(10, 80))]
        toxic = n % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(nasty) + rng.choice(["", "s", "ish"]))
        rows.append((n, " ".join(words)))
        labels.append((n, 1, int(toxic)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark, labelled):
    rows, labels = labelled
    # What the held-out fold's labels say must not matter.
    lies = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in labels]
    extra = [(1000, None), (1001, ""), (None, "wa wb"), (1002, "WAA WAB"), (1000, None)]
    marks = spark.createDataFrame(lies + [(1, 1, None), (None, 1, 1), (2, 1, 0)], LABELS)
    got = toxicity.score(clashing(docs(spark, rows + extra)), marks).collect()
    assert len(got) == 605
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 60 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.97


def test_words_of_all_labelled_rows_count(spark, labelled, monkeypatch):
    rows, labels = labelled
    marks = spark.createDataFrame(labels, LABELS)
    whole = toxicity.fit(docs(spark, rows), marks)
    monkeypatch.setattr(toxicity, "SAMPLE", 12)
    few = toxicity.fit(docs(spark, rows), marks)
    assert len(few.vocabulary) > 3 and few.vocabulary == whole.vocabulary and few.lexicon == whole.lexicon


def test_repeated_rows_and_labels_without_documents_change_nothing(spark, labelled):
    rows, labels = labelled
    marks = spark.createDataFrame(labels + [(i, 1, i % 2) for i in range(5000, 9000)], LABELS)
    once = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    want = {r.doc_id: r.predicted for r in toxicity.score(docs(spark, rows), marks).collect()}
    for times in (2, 3):
        df = docs(spark, rows * times).repartition(7)
        model = toxicity.fit(df, marks)
        assert model.vocabulary == once.vocabulary and model.lexicon == once.lexicon
        got = toxicity.score(df, marks).collect()
        assert len(got) == times * len(rows) and all(r.predicted == want[r.doc_id] for r in got)
    held = [i for i, _, t in labels if t and zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(want[i] for i in held) >= 0.9 * len(held) > 5
    # One document a third of all rows.
    many = docs(spark, rows + [rows[0]] * 300)
    assert toxicity.fit(many, marks).vocabulary == once.vocabulary


def test_features_are_counted_as_by_hand(spark, labelled):
    rows, labels = labelled
    truth = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5}
    n, counts = [sum(t == k for t in truth.values()) for k in (0, 1)], {}
    for i, text in rows:
        if i in truth:
            for feature in toxicity._present(Counter(text.lower().split())):
                counts.setdefault(feature, [0, 0])[truth[i]] += 1

    def part(seen, of, rate):
        missing = (of - seen) * math.log((of - seen + 0.5) / (of * (1 - rate) + 0.5))
        return seen * math.log((seen + 0.5) / (of * rate + 0.5)) + missing

    kept = {f: c for f, c in counts.items() if sum(c) >= toxicity.SUPPORT}
    ratios = {f: sum(part(c[k], n[k], sum(c) / sum(n)) for k in (0, 1)) for f, c in kept.items()}
    best = sorted((f for f in ratios if ratios[f] > math.log(len(kept))), key=lambda f: (-round(ratios[f], 6), f))
    model = toxicity.fit(docs(spark, rows), spark.createDataFrame(labels, LABELS))
    assert list(model.vocabulary) == best[: toxicity.VOCABULARY] and len(best) > 20


def test_many_labels_go_by_a_join(spark, labelled, monkeypatch):
    rows, labels = labelled
    marks = spark.createDataFrame(labels, LABELS)
    want = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs(spark, rows), marks).collect()}
    monkeypatch.setattr(toxicity, "KNOWN_ROWS", 10)
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.score(docs(spark, rows), marks).collect()}
    assert {i: p for i, (_, p) in got.items()} == {i: p for i, (_, p) in want.items()}
    assert all(abs(got[i][0] - want[i][0]) < 1e-6 for i in want)


def test_query_scores_every_row(spark):
    found = catalog.op7_toxicity(spark, "/root/testdata/sf0.001").collect()
    ids = [r.doc_id for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in found) == sorted(ids) and {r.predicted for r in found} <= {0, 1}


def test_without_labels_nothing_is_toxic(spark):
    df = clashing(docs(spark, [(1, "a b"), (2, None)]))
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.score(df, none).collect()] == [0.0, 0.0]
    kept = toxicity.without_toxic(df, none)
    assert kept.columns == df.columns and kept.count() == 2
    assert toxicity.without_toxic(df.limit(0), none).count() == 0


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body>
<header class=top><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site to make it better for you and for us.</div>
<aside>By the way</aside>%s<div id="comments"><p>A reader says that this is all wrong, at great length.</p></div>
<form>Name <input name=n><button>Send</button></form><footer>&copy; 2024</footer></body></html>"""


@pytest.mark.parametrize(
    "article",
    [
        "<article><h1>A  title</h1><p>First &amp; <b>best</b>\n part.<p>Sec<i>ond</i>.<div class=ad>Buy</div><ul><li>x<li>y</ul></article>",
        "<div class=content><h1>A title</h1><p>First &amp; best part.</p><p>Second.</p><ul><li>x</li><li>y</li></ul></div>",
        "<main><header><h1>A title</h1></header><section><p>First &amp; best<br>part.</section><p>Second.<p>x<p>y</main>",
    ],
)
def test_the_article_alone_comes_out(article):
    assert main_text(PAGE % article) == "A title First & best part. Second. x y"


def test_odd_pages(spark):
    assert main_text(None) == main_text("") == main_text("<p> </p><script>x") == ""
    assert main_text("no tags &lt;here") == "no tags <here"
    assert main_text("<p>a<b>b</p></b></i><p>c") == "ab c"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    long = "<article>" + "<p>word</p>" * 20000 + "</article>"
    assert main_text(long) == " ".join(["word"] * 20000)
    df = clashing(spark.createDataFrame([(1, "u", PAGE % "<p>x"), (2, None, None), (2, None, None)], "page_id long, url string, html string"))
    rows = extract(df).collect()
    assert [r.text for r in rows][1:] == ["", ""] and "x" in rows[0].text and rows[0].key == "own key"
    assert extract(df.limit(0)).count() == 0


def _paragraphs(*sizes):
    return "".join("<p>" + ("word " * n)[:n].strip() + ".</p>" for n in sizes)


@pytest.mark.parametrize("tag", ["section", "div", "td", "article"])
@pytest.mark.parametrize(
    "parts",
    [((500, 450, 480), (220, 260, 240)), ((500,), (500,)), ((600,) * 3, (200,) * 2, (200,) * 2), ((2000,), (50, 45), (60,)), ((30, 25), (20, 22))],
)
def test_sibling_parts_of_a_text_all_come_out(tag, parts):
    inner = "".join(f"<{tag}>{_paragraphs(*sizes)}</{tag}>" for sizes in parts)
    inner = f"<table><tr>{inner}</tr></table>" if tag == "td" else inner
    menu = "<div><ul>" + "<li><a href=/x>Link</a></li>" * 8 + "</ul></div>"
    want = " ".join(("word " * n)[:n].strip() + "." for sizes in parts for n in sizes)
    assert main_text(f"<html><body><div>{inner}</div></body></html>") == want
    if max(map(max, parts)) > 40:  # then it differs from a menu without a name
        assert main_text(f"<html><body>{menu}<div>{inner}</div></body></html>") == want


def test_text_beside_an_article_comes_along():
    page = f"<body><article>{_paragraphs(100)}</article><div>{_paragraphs(3000)}</div></body>"
    assert main_text(page) == main_text(f"<body>{_paragraphs(100, 3000)}</body>")
    assert main_text(f"<main><h2>Two</h2><article>{_paragraphs(80)}</article><article>{_paragraphs(70)}</article></main>").count("word") == 30


@pytest.mark.parametrize(
    "wrapper",
    [
        'div class="content has-sidebar"', 'div class="no-sidebar"', 'article class="post comments-open"', 'div id="search-result"',
        'div class="commentary"', 'section class="widget"', 'div class="page has-header"', 'p class="commentary"',
    ],
)
def test_names_on_wrappers_leave_the_text_in(wrapper):
    want = main_text(f"<article><h1>A title</h1>{_paragraphs(400, 90, 300)}</article>")
    text = f"<h1>A title</h1>{_paragraphs(400, 90, 300)}" if wrapper[0] != "p" else want
    inner = f"<{wrapper}>{text}<div class=sidebar>{_paragraphs(150)}</div></{wrapper.split()[0]}>"
    assert main_text(f"<body>{inner}</body>") == want
    assert main_text(f"<body><div class=layout><nav>menu</nav>{inner}</div><footer>2024</footer></body>") == want
    assert main_text(PAGE % inner) == want


def test_names_on_all_parts_leave_the_text_in():
    parts = "".join(f'<div class="search-result">{_paragraphs(200, 100)}</div>' for _ in range(9))
    assert main_text(f"<body>{parts}</body>") == main_text(f"<body>{_paragraphs(*[200, 100] * 9)}</body>")
    # More comments than text are still comments.
    page = f'<div class="no-sidebar"><h1>A title</h1>{_paragraphs(300)}<div id=comments>{_paragraphs(500, 500, 500)}</div></div>'
    assert main_text(f"<body>{page}</body>") == main_text(f"<body><h1>A title</h1>{_paragraphs(300)}</body>")


@pytest.mark.parametrize(
    "html, want",
    [
        ("a<![ b", "a"), ("<![>x", "x"), ("<p>q<![1]>z", "qz"), ("<![foo[ x> y", "y"), ("<![CDATA[ a > b ]]>c", "c"),
        ("<![CDATA[ a > b", "b"), ("<p>a<!-- b", "a"), ("<p>a<!-- b --", "a"), ("x <a href='q", "x"), ("a < b", "a < b"), ("</a", ""),
        ("<!doctype html", ""), ("5 &lt 6 &amp", "5 < 6 &"), ("<p>a</p>text<b", "a text"), ("<script>x<y", ""), ("x<?php a ?>y", "xy"),
        ("<p>a<!-->b<p>c", "a"), ("<p>a<!-- x --><p>b", "a b"),
    ],
)
def test_broken_markup(html, want):
    assert main_text(html) == want


@pytest.mark.parametrize("unit", ["<a ", "<!-- ", "<![CDATA[ ", "<![ ", "</a ", "<a '", "<? ", "&", "<b>", "<p><b>", "</i>", "<div class=ad>", "<"])
@pytest.mark.parametrize("end", ["", ">"])
def test_time_grows_with_the_page(unit, end):
    def taken(n):
        began = time.perf_counter()
        main_text(unit * n + end)
        return time.perf_counter() - began

    taken(100)
    assert min(taken(40_000) for _ in range(2)) < 40 * max(min(taken(4_000) for _ in range(2)), 0.02)


def test_menu_footer_and_comments_without_plain_names():
    menu = "<div><ul>" + "<li><a href=/x>Some link</a></li>" * 6 + "</ul></div>"
    footer = "<div><p>© 2024 The people who made this, all of them. All rights reserved.</p><a href=/i>Imprint</a></div>"
    want = main_text(f"<body><div>{_paragraphs(400, 90, 300)}</div></body>")
    assert main_text(f"<body>{menu}<div>{_paragraphs(400, 90, 300)}</div>{footer}</body>") == want
    for name in ("responses", "discussion"):
        said = f'<div class="{name}">{_paragraphs(80, 70)}</div>'
        assert main_text(f"<body><article>{_paragraphs(400, 90, 300)}{said}</article></body>") == want
        assert main_text(f"<body>{menu}<div>{_paragraphs(400, 90, 300)}</div>{said}{footer}</body>") == want
    # Links between paragraphs belong to the text; a page of links alone is one.
    inner = f"{_paragraphs(300)}<p><a href=/x>a link</a></p>{_paragraphs(300)}"
    assert "a link" in main_text(f"<body><div>{inner}</div></body>")
    assert main_text(menu) == " ".join(["Some link"] * 6)


def test_ratio_smoothing_and_threshold_as_by_hand():
    rng = random.Random(4)
    for _ in range(200):
        lines = [("x" * rng.choice([3, 8, 30, 200, 500]), rng.randint(0, 9), 0) for _ in range(rng.randint(1, 12))]
        unlinked = [rng.choice([0, len(text)]) for text, _, _ in lines]
        ratios = [len(text) / max(tags, 1) for text, tags, _ in lines]
        smooth = []
        for i in range(len(ratios)):
            near = [(math.exp(-0.5 * (i - j) ** 2), ratios[j]) for j in range(len(ratios)) if abs(i - j) <= 2]
            smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
        # Two means, from the mean of all.
        border = sum(smooth) / len(smooth)
        for _ in range(50):
            low, high = [v for v in smooth if v < border], [v for v in smooth if v >= border]
            if not low or not high or border == (sum(low) / len(low) + sum(high) / len(high)) / 2:
                break
            border = (sum(low) / len(low) + sum(high) / len(high)) / 2
        low, high = [v for v in smooth if v < border - 1e-9], [v for v in smooth if v >= border - 1e-9]
        if not low or sum(high) / len(high) < html_extract.CLOSE * sum(low) / len(low):
            border = min(smooth)
        want = [
            s >= border - 1e-9 and (free > 0 or r >= border - 1e-9) or free >= html_extract.PROSE
            for s, r, free in zip(smooth, ratios, unlinked)
        ]
        got = html_extract._content(lines, unlinked)
        assert got.tolist() == (want if any(want) else [True] * len(want))


def test_query_gives_the_main_text_of_every_page(spark):
    folder = "/root/testdata/sf0.001"
    found = {r.page_id: r for r in catalog.op10_html(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages) > 20
    for page in pages:
        text = main_text(page.html)
        assert tuple(found[page.page_id]) == (page.page_id, page.url, text, len(text))
