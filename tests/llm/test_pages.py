"""Extraction on unseen made pages, exact inference against enumeration, and edge cases."""

import random
import re
import time
from itertools import product
from math import exp

import pytest

from eventloom.llm import pages as P


def test_unseen_layouts():
    rng = random.Random(77)
    model, right, total = P.trained(), 0, 0
    for _ in range(150):
        tree, labels = P.labelled(P.labelled_page(rng))
        belief, _ = model.messages(tree)
        for text, b, label in zip(tree.text, belief, labels, strict=True):
            if text is not None:
                right, total = right + ((b > 0.5) == bool(label)), total + 1
    assert right > 0.98 * total


def test_messages_equal_enumeration():
    model = P.trained()
    tree = P.parse("<body><nav><a>x</a></nav><article><h1>T</h1><p>a b c.</p></article><div class=ad>y</div></body>")
    n = len(tree.parent)
    sums, total = [0.0] * n, 0.0
    for state in product((0, 1), repeat=n):
        score = sum(sum(model.weights.get(f, 0.0) for f in tree.features[i]) for i in range(n) if state[i])
        score += sum(model.pair[tree.kind[i]][state[tree.parent[i]]][state[i]] for i in range(1, n))
        total += exp(score)
        for i in range(n):
            sums[i] += exp(score) * state[i]
    belief, _ = model.messages(tree)
    assert all(abs(b - s / total) < 1e-6 for b, s in zip(belief, sums, strict=True))


def test_parsing():
    texts = lambda page: [t for t in P.parse(page).text if t is not None]
    assert texts("<p>a&amp;b &nbsp; c<p>d<b>e</b>f<br>g<script>var t='</p>';</script>h") == ["a&b c", "def", "gh"]
    assert texts("<title>x</title><body><ul><li>a<li>b</ul>c<!-- d --><x-y>e</x-y>") == ["a", "b", "ce"]
    assert texts("1 < 2 &lt;b&gt; <a title='>'>q</a>") == ["1 < 2 <b> q"]
    assert texts("a <p class='") == ["a"]
    assert texts("<textarea>q</textarea><style>p{}") == []


def test_references_end_with_their_piece():
    texts = lambda page: [t for t in P.parse(page).text if t is not None]
    assert texts("x &<b>lt;</b> y") == ["x &lt; y"]
    assert texts("a &am<!-- -->p; b &amp;lt; c") == ["a &am p; b &lt; c".replace("am p", "amp")]


def test_tags_in_scripts_and_broken_tags():
    texts = lambda page: [t for t in P.parse(page).text if t is not None]
    assert texts("<script>if (a<b && c) x=\"'</script><p title='q'>one</p><p>two") == ["one", "two"]
    assert texts("<p>a<i title='x>b</i></p><p>c</p>") == ["a<i title='x>b", "c"]
    assert texts("<p>a <b x='1>2' y=\">\">c</b> <! d <p>e") == ["a c e"]
    # The same tags by the plain expression and by the table of ends.
    rng = random.Random(3)
    for _ in range(2000):
        page = "".join(rng.choice(["<a ", "<b", ">", "'", '"', " ", "x", "/", "<", "</i", "<!", "="]) for _ in range(rng.randint(0, 30)))
        plain, table = P.Tags(page), P.Tags(page)
        table.ends = P.TagEnds(page)
        at = 0
        while True:
            start = page.find("<", at)
            match = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)|![^>]*)>").search(page, at)
            got, other = plain.after(at), table.after(at)
            assert got == other, page
            assert (got and got[:2]) == (match and match.span()), page
            if got is None:
                break
            at = got[1]


@pytest.mark.parametrize("part", ["<div>", "<a ", "<a", "<a '", "<a '\"", "<!", "<p><li>", "<div><li>", "</div>", "<script>", "&lt", "<li></li><div>", "<a \"\" ", "<!--", "<svg "])
def test_time_is_linear(part):
    def seconds(n):
        began = time.perf_counter()
        P.parse(part * n)
        return time.perf_counter() - began

    seconds(1000)
    assert min(seconds(20_000) for _ in range(3)) < 5 * min(seconds(10_000) for _ in range(3)) + 0.02


def test_page():
    body = "<nav><ul><li><a href=x>Menu</a></li></ul></nav><div class=cookie-notice><p>We use them.</p></div><article><h1>Big news</h1><p>First &eacute; part.</p><p><b>Second\n part.<br><p>Third part of it.</article><div class=comments><p>I think so too, friends.</p></div><footer>&copy; us</footer>"
    assert P.trained().extract(f"<html><body>{body}</body></html>") == "Big news First é part. Second part. Third part of it."


def test_edges(spark):
    long = "<article>" + "<p>Some words of the text.</p>" * 20_000 + "</article>"
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "v", "<div><div>", "x"), (3, "w", long, "x"), (4, "w", "<" * 50_000, "x"), (5, "w", "<div>" * 3000, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in P.main_text(frame).collect()}
    assert len(got) == 6 and got[3, "w"] == " ".join(["Some words of the text."] * 20_000)
    assert all(t == "" for k, t in got.items() if k[0] not in (3, 4))
    assert P.main_text(frame.limit(0)).count() == 0
