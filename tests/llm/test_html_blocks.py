"""Main text: blocks and features against plain code, verdicts with and without telling names, and pages that never close."""

import html
import re
import time
from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidefleet.llm import html_blocks as H
from tidefleet.llm.html_examples import MARKED, Writer

SF = "/root/testdata/sf0.01"


def test_main_text(spark):
    page = (
        '<html><head><title>no</title><script>x="<p>no</p>"</script></head><body><nav><a href="/">no</a></nav><!-- <p>no</p> --><div class="cookie-banner">we use no cookies</div><main><h1>Yes &amp;\n yes</h1>'
        '<p>Some <b>bold</b>&nbsp;text<br>here<p>x<form><input value="a>b">no</form><aside>no no</aside><p>last</main><div id="comments"><p>no comment</p></div><footer>no</footer></body></html>'
    )
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<article><p>open", "x"), (1, "u", page, "x"), (None, "u", "<<<>>", "x")]
    found = [tuple(r) for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()]
    text = "Yes & yes Some bold text here x last"
    assert found[0] == (1, "u", text, len(text)) == found[4]
    assert [r[2] for r in found[1:4]] == ["", "", "open"] and found[1][3] == 0
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


class Plain(HTMLParser):
    """Flat blocks as (text, words, linked words, section), by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.blocks, self.open, self.text, self.links, self.in_link, self.hidden, self.sections = [], [], "", "", False, 0, 0

    def end_block(self):
        text = " ".join(self.text.split())
        if text:
            section = next((n for t, n in reversed(self.open) if t not in H.PARTS), 0)
            self.blocks.append((text, len(text.split()), len(self.links.split()), section))
        self.text = self.links = ""

    def handle_starttag(self, tag, attrs):
        if tag in H.HIDDEN:
            self.hidden += 1
        elif tag == "a":
            self.in_link = True
        elif tag in H.BLOCKS:
            self.end_block()
            if tag in H.CONTAINERS:
                self.sections += 1
                self.open.append((tag, self.sections))

    def handle_endtag(self, tag):
        if tag in H.HIDDEN:
            self.hidden -= 1
        elif tag == "a":
            self.in_link = False
        elif tag in H.BLOCKS:
            self.end_block()
            if tag in H.CONTAINERS:
                assert self.open.pop()[0] == tag

    def handle_data(self, data):
        if not self.hidden:
            self.text += data
            self.links += f" {data}" if self.in_link else ""


def test_blocks_and_features_by_plain_code():
    for seed in range(2000, 2060):
        page = Writer(seed).page()
        p = Plain()
        p.feed(page)
        p.close()
        p.end_block()
        found = H.parsed(page)
        assert [(b.text, b.words, b.linked) for b in found.blocks] == [b[:3] for b in p.blocks]
        x = {n: H.described(found)[:, i] for i, n in enumerate(H.FEATURES)}
        for i, (_, words, linked, section) in enumerate(p.blocks):
            beside = [(p.blocks[j][1], p.blocks[j][2] / p.blocks[j][1]) if 0 <= j < len(p.blocks) else (0, 0) for j in (i - 1, i + 1)]
            ours = [b for b in p.blocks if b[3] == section]
            assert [x[n][i] for n in ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after")] == [words, linked / words, *beside[0], *beside[1]]
            assert x["longest_near"][i] == max([b[1] for b in p.blocks[max(0, i - 3) : i + 4] if b[2] < 0.3 * b[1]], default=0)
            assert x["elsewhere"][i] == sum(b[1] for b in p.blocks) - sum(b[1] for b in ours)
            assert x["section_words"][i] == sum(b[1] - b[2] for b in ours) and x["section_link_density"][i] == sum(b[2] for b in ours) / sum(b[1] for b in ours)


def test_tree_by_plain_code():
    tree = H.trained()
    x = np.concatenate([H.described(H.parsed(Writer(seed).page())) for seed in range(3000, 3040)])

    def plain(row):
        node = tree
        while node.feature >= 0:
            node = node.below if row[node.feature] < node.split else node.above
        return node.share >= 0.5

    assert H.judged(tree, x).tolist() == [plain(row) for row in x]


def test_words_and_links_of_neighbours_decide():
    used = {}

    def walk(node, depth):
        if node.feature >= 0:
            used[H.FEATURES[node.feature]] = min(depth, used.get(H.FEATURES[node.feature], 99))
            walk(node.below, depth + 1)
            walk(node.above, depth + 1)

    walk(H.trained(), 0)
    assert {"words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "section_words"} <= set(used)
    assert used["outside"] == 0 and used["section_link_density"] == 1


def test_held_out_pages():
    tree, right, blocks = H.trained(), 0, 0
    for seed in range(6000, 6200):
        found = H.parsed(Writer(seed).page())
        verdict = H.judged(tree, H.described(found))
        right += sum(v == b.text.startswith(MARKED) for v, b in zip(verdict, found.blocks, strict=True))
        blocks += len(verdict)
    assert right / blocks >= 0.99


def article(page):
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*?)(</article>|\Z)", page, re.DOTALL)[1])).split())


def no_names(page):
    return re.sub(r'\s(?:class|id|role)="[^"]*"', "", page)


def no_article(page):
    return re.sub(r"<(/?)article>", r"<\1div>", page)


def only_div(page):
    return re.sub(r"<(/?)(?:article|nav|footer)\b", r"<\1div", no_names(page))


@pytest.mark.parametrize(("change", "least"), [(lambda p: p, 1.0), (no_names, 0.9), (no_article, 0.9), (lambda p: no_article(no_names(p)), 0.9), (only_div, 0.9)])
def test_pages_of_the_test_data(change, least):
    pages = [r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]
    exact = sum(H.main_text(change(p), H.trained()) == article(p) for p in pages)
    assert exact >= least * len(pages)


def said(n, seed=0):
    words = "harbor lantern quiet meadow signal copper winter garden stone ribbon thirteen velvet".split()
    return " ".join(words[(i * 7 + seed + i // 5) % len(words)] for i in range(n)) + "."


SURROUNDINGS = (
    '<aside class="sidebar">{}</aside>', '<div class="cookie-consent">{}</div>', '<div class="comments">{}</div>', '<section class="comments">{}</section>', '<div class="related">{}</div>',
    '<div id="comments"><h2>Three replies</h2><article class="comment"><p>Jo</p>{}</article></div>',
)


@pytest.mark.parametrize("around", SURROUNDINGS)
@pytest.mark.parametrize("share", [0.5, 0.9, 1.1, 1.5, 3, 10])
def test_surroundings_of_any_length_stay_out(around, share):
    for seed in range(12):
        text = [said(12 + 7 * seed, seed), said(70, seed + 1)]
        n = int(share * sum(len(t.split()) for t in text))
        inner = around.format("".join(f"<p>{said(min(25 + seed, n - i), seed + i)}</p>" for i in range(0, n, 25 + seed)))
        main = "<article><h1>A walk by the harbor</h1>" + "".join(f"<p>{t}</p>" for t in text) + "</article>"
        for page in (main + inner, inner + main):
            page = f'<html><body><nav><a href="/">start</a> <a href="/b">all pages</a></nav>{page}<footer>2020 the makers</footer></body></html>'
            assert H.main_text(page, H.trained()) == " ".join(["A walk by the harbor", *text])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 20, 30, 40, 55, 60, 100, 1000])
def test_a_page_without_surroundings_is_main_text(n):
    t = said(n)
    for page, text in ((f"<p>{t}</p>", t), (t, t), (f"<html><head><title>no</title></head><body><p>{t}</p></body></html>", t), (f"<h1>Title</h1><p>{t}</p>", f"Title {t}"), (f"<div><p>{t}</p></div>", t), (f"<article><p>{t}</p></article>", t)):
        assert H.main_text(page, H.trained()) == text


HAND_WRITTEN = [
    (f'''<!DOCTYPE html><html><body class="home has-sidebar no-comments"><header class="site-header"><a href="/">The Daily Pond</a><nav><ul><li><a href="/n">News</a></li><li><a href="/w">Weather</a></li></ul></nav></header>
    <div class="with-sidebar"><main><article><h1>Ducks return</h1><p class="byline">By Ann</p><p>{said(60)}</p><h2>Why now</h2><p>{said(8)}</p><blockquote><p>{said(15)}</p></blockquote><p>{said(45)}</p></article></main>
    <aside class="sidebar"><h3>About us</h3><p>{said(130)}</p></aside></div><footer><p>&copy; 2021 Pond</p></footer></body></html>''', f"Ducks return {said(60)} Why now {said(8)} {said(15)} {said(45)}"),
    (f'''<div id="page"><div id="menu"><a href="a">one</a> <a href="b">two</a></div><div id="content"><h1>Soup</h1><p>{said(40)}</p><ul><li>{said(4)}</li><li>{said(3)}</li></ul><p>{said(50)}</p></div>
    <div id="comments"><h3>Comments</h3><ol><li><div class="comment"><p>Lee</p><p>{said(90)}</p></div></li><li><div class="comment"><p>Kim</p><p>{said(120)}</p></div></li></ol></div></div>''', f"Soup {said(40)} {said(4)} {said(3)} {said(50)}"),
    (f'''<body><div class="cookie-notice"><p>{said(200)}</p></div><main class="page-with-ads"><h1>Short</h1><p>{said(20)}</p><div class="advert"><p>{said(12)}</p></div></main></body>''', f"Short {said(20)}"),
    (f'''<body><form><p>Search here</p><label>words</label></form><article><p>{said(30)}</p><p>{said(2)}</p><script>var a = "<p>x</p>";</script><p>{said(30, 3)}</p></article><section class="related"><h2>More</h2><p>{said(300)}</p></section></body>''', f"{said(30)} {said(2)} {said(30, 3)}"),
]


@pytest.mark.parametrize(("page", "text"), HAND_WRITTEN)
def test_hand_written_pages(page, text):
    assert H.main_text(page, H.trained()) == text


@pytest.mark.parametrize("part", ["<script ", "<a ", "<p class=\"", "<svg>", "<!--", "<div>", "</div>", "<div></p>", "<a href='", "&#99999999", "class=", "<"])
def test_long_pages_take_linear_time(part):
    began = time.perf_counter()
    H.main_text(part * (1_000_000 // len(part)), H.trained())
    H.main_text("<div>" * 50_000 + part * 50_000 + "</ul></div>" * 50_000, H.trained())
    assert time.perf_counter() - began < 3
