"""Wrappers: hard markup, and alignment against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from urbanlake.llm import wrappers


def extracted(spark, pages):
    rows = [(k, f"http://{host}/{k}", html) for k, (host, html) in enumerate(pages)]
    got = wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return [r.text.split("\n\n") for r in sorted(got, key=lambda r: r.page_id)]


def test_blocks_of_one_page_stay_and_constants_go(spark):
    pages = [f"<div><p>Shared line.</p>{''.join(f'<p>text {k} {i}</p>' for i in range(4 * k + 1))}<p>Copyright 2020</p></div>" for k in range(6)]
    pages[5] += "<section><blockquote>only here</blockquote></section>"
    got = extracted(spark, [("a", p) for p in pages])
    assert got == [[f"text {k} {i}" for i in range(4 * k + 1)] + ["only here"] * (k == 5) for k in range(6)]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<div><p>one</p><p title=it's href=x>two</p><p>three three</p></div>", ["one", "two", "three three"]),
        ('<p class="x>one</p><p>two two two</p>', ["one", "two two two"]),
        ("<p>a</p><p title='>' class=\"a>b\">c</p>", ["a", "c"]),
        ("<p>first<b", ["first"]),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math><object>shown</object>", ["x=2", "shown"]),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, ["deep"]),
        ("<p>" + "long " * 200_000, [" ".join(["long"] * 200_000)]),
        ("<select><option>x</select><textarea>y</textarea><p>z", ["z"]),
    ],
)
def test_hard_markup(html, want):
    page = wrappers.parse(html)
    own = wrappers.measured(wrappers.unpack(wrappers.pack(wrappers.folded(page))))
    assert wrappers.main_text(page, own).split("\n\n") == want == wrappers.main_text(page, None).split("\n\n")


def test_deep_pages_run_as_a_job(spark):
    got = extracted(spark, [("d", "<div>" * 3000 + f"deep {k}" + "</div>" * 3000) for k in range(4)])
    assert got == [[f"deep {k}"] for k in range(4)]


def stream(r, n):
    out = []
    for _ in range(n):
        item = wrappers.Item(r.choice(("p", "h2", "div|nav|x")))
        item.items = [wrappers.Item(wrappers.TEXT, r.choice("uvw"))]
        item.items[0].pages = (1,)
        out.append(item)
    return out


def best(a, b):
    """The largest worth of a common stream, over all choices of equally many items of both."""
    found = 0
    for n in range(min(len(a), len(b)) + 1):
        for x in itertools.combinations(a, n):
            for y in itertools.combinations(b, n):
                worth = [wrappers.gain(p, q) for p, q in zip(x, y, strict=True)]
                if all(worth):
                    found = max(found, sum(worth))
    return found


def test_alignment_equals_brute_force():
    r = random.Random(2)
    for _ in range(150):
        a, b = stream(r, r.randrange(6)), stream(r, r.randrange(6))
        want, n = best(a, b), len(a) + len(b)
        out = wrappers.align(a, b)
        common = [x for x in out if not x.optional]
        assert len(out) == n - len(common)
        assert sum(3 if wrappers.mark(x) is not None else 2 for x in common) == want
        hashed = [wrappers.folded(x) for x in b]
        pairs = [(x, y) for x, y in zip(a, wrappers.matched(a, hashed), strict=True) if y]
        assert sum(3 if wrappers.text_hash(wrappers.mark(x)) == wrappers.mark(y) else 2 for x, y in pairs) == want


def test_long_runs_become_repeated_groups():
    long = wrappers.folded(wrappers.parse("".join(f"<li>{i}" for i in range(50))))
    assert [x.repeated for x in long.items] == [False] * 3 + [True] + [False] * 3
    pairs = wrappers.folded(wrappers.parse("".join(f"<h2>{i}</h2><p>{i}</p>" for i in range(50))))
    assert [x.key for x in pairs.items] == ["h2", "p"] * 7 and sum(x.repeated for x in pairs.items) == 2
    again = wrappers.parse("".join(f"<h2>{i}</h2><p>{i}</p>" for i in range(30))).items
    assert [x.key for x in wrappers.matched(again, pairs.items)] == ["h2", "p"] * 30
    back = wrappers.unpack(wrappers.pack(pairs))
    assert wrappers.pack(back) == wrappers.pack(pairs)


def test_extra_columns_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://h/1", "<p>a</p>", "x", "y", "z"), (1, "http://h/1", "<p>a</p>", "x", "y", "z"), (None, None, None, "", "", "")], "page_id long, url string, html string, host string, wrapper string, text string")
    assert sorted((r.page_id or 0, r.text) for r in wrappers.extract_pages(pages).collect()) == [(0, ""), (1, "a"), (1, "a")]
    assert wrappers.extract_pages(pages.filter(F.lit(False))).count() == 0


def texts(spark, pages):
    rows = spark.createDataFrame([(i, "http://made.example/p", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in wrappers.extract_pages(rows).collect()}


def test_the_wrapper_decides_what_stays(spark):
    """Every page's text is another one without the wrapper: slots before the article stay, constants around it go."""
    body = "<p>First words of story %d.</p><p>More of it, %d times, and longer than all the rest of the page together, so that no share of the text would tell.</p>"
    page = "<div class=x>Our paper</div><div class=y>Headline %d</div><article>" + body + "</article><div class=z>Copyright 2020 All rights reserved by us.</div>"
    pages = [page % (k, k, k) for k in range(6)]
    found = texts(spark, pages)
    for k in range(6):
        assert found[k] == f"Headline {k}\n\nFirst words of story {k}.\n\n" + "More of it, %d times, and longer than all the rest of the page together, so that no share of the text would tell." % k
    changed = [k for k in range(6) if wrappers.main_text(wrappers.parse(pages[k]), None) != found[k]]
    assert changed == list(range(6))


def test_one_page_of_a_host_keeps_its_article(spark):
    assert texts(spark, ["<div>Our paper</div><article><p>Story.</p></article>"]) == {0: "Story."}
    assert texts(spark, ["<div>Only this</div>"]) == {0: "Only this"}


def test_articles_of_comments_and_adverts_go(spark):
    page = '<main class="page with-sidebar"><article class="post"><p>Story %d.</p></article><article class="comment"><p>I %d agree.</p></article><article class="ad sponsored"><p>Buy %d.</p></article></main>'
    assert texts(spark, [page % (k, k, k) for k in range(4)]) == {k: f"Story {k}." for k in range(4)}
