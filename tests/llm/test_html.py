from __future__ import annotations

import random
import re
from html.parser import HTMLParser

import pytest
from tests.llm.conftest import SMALL

from orderlens.llm import html_text, queries
from orderlens.llm.html_text import render


class Plain(HTMLParser):
    """All text outside scripts, styles and titles, blocks parted by blanks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attributes):
        self.hidden += tag in ("script", "style", "title")
        self.out.append(" " if tag in html_text.BLOCKS or tag == "br" else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        self.out.append(" " if tag in html_text.BLOCKS else "")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def unmarked(text):
    return [w for w in text.split() if w != "-" and not re.fullmatch(r"-?\d+\.", w)]


def test_all_words_of_all_pages(spark):
    got = {r.page_id: r for r in queries.op9_html_text(spark, SMALL).collect()}
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        parser = Plain()
        parser.feed(page.html)
        parser.close()
        assert unmarked(got[page.page_id].text) == unmarked("".join(parser.out))
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


def test_layout():
    assert render("<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>f") == "- a\n- b\n  3. c\n  4. d\n- e\n\nf"
    assert render("<table><tr><th>name<th>n<tr><td>x<td>12<br>3</table>") == "name  n\nx     12\n      3"
    assert render("<p>one<p>two &amp; <b>th</b>ree<div>four</div>five") == "one\n\ntwo & three\n\nfour\nfive"
    assert render("a<pre>x\n  y</pre>b<br>c<br><br>d") == "a\n\nx\n  y\n\nb\nc\n\nd"
    assert render("<dl><dt>t<dd>d1<dd>d2</dl><h1>h</h1>x") == "t\nd1\nd2\n\nh\n\nx"
    assert render("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>") == "a     d\n\nb  c"


def test_visibility():
    page = "<head><title>t</title><style>s</style></head><body><div hidden>h</div><p style='display: NONE'>n</p><!-- c -->"
    page += "<script>if (a < b) '</p>'</script><template>t</template><span style=visibility:hidden>v</span>seen<noscript>n</noscript>"
    assert render(page) == "seen"
    assert render("<p>a<script>x") == "a"


def test_bad_markup():
    assert render(None) == render("") == render("<div><p></p></div>") == ""
    assert render("</p></b>a</td><b>c</i>d") == "acd"
    assert render("1 < 2 && 3 > 2") == "1 < 2 && 3 > 2"
    assert render("<a href='x>y' title=\"q\">link</a") == "link"
    assert render("<td>a</td><tr>b</tr><li>c") == "a\nb\n- c"
    assert render("<div>" * 50_000 + "deep") == "deep"
    assert render("<b><p>" * 5_000 + "x") == "x"
    assert len(render("<p>w " * 20_000).split()) == 20_000


def test_odd_rows(spark):
    rows = [(1, "<p>a", "t"), (1, "<p>a", "t"), (None, None, "t"), (2, "", "t")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract_text(df)
    assert got.columns == ["page_id", "n_chars", "text"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 1, "a"), (1, 1, "a"), (None, 0, ""), (2, 0, "")]))
    assert html_text.extract_text(df.limit(0)).count() == 0


def grid(rows):
    """First column of every cell, by filling a grid of squares one by one."""
    taken, firsts = set(), {}
    for y, row in enumerate(rows):
        x = 0
        for name, wide, high in row:
            while any((y, x + i) in taken for i in range(wide)):
                x += 1
            firsts[name] = (y, x)
            taken |= {(y + j, x + i) for i in range(wide) for j in range(high)}
            x += wide
    return firsts


@pytest.mark.parametrize("seed", range(30))
def test_generated_tables_are_aligned(seed):
    rng = random.Random(seed)
    rows, pieces = [], []
    for y in range(rng.randint(1, 6)):
        row = [(f"r{y}c{i}" + "x" * rng.randrange(9), rng.choice((1, 1, 1, 2, 3)), rng.choice((1, 1, 1, 2))) for i in range(rng.randint(1, 5))]
        rows.append(row)
        cells = "".join(f"<td colspan={wide} rowspan='{high}'>{name}" for name, wide, high in row)
        pieces.append(f"<tr>{cells}")
    lines = render("<table>" + "".join(pieces) + "</table>").split("\n")
    firsts, offsets = grid(rows), {}
    assert [line.split() for line in lines] == [[name for name, _, _ in row] for row in rows]
    for name, (y, x) in firsts.items():
        at = lines[y].index(name)
        assert offsets.setdefault(x, at) == at
        assert at == 0 or lines[y][:at].endswith("  ")
    assert [offsets[x] for x in sorted(offsets)] == sorted(offsets.values())


def brute_list(items, depth=0):
    lines = []
    for number, (text, inner) in enumerate(items, 1):
        lines.append("  " * depth + (f"{number}. " if depth % 2 else "- ") + text)
        lines += brute_list(inner, depth + 1)
    return lines


@pytest.mark.parametrize("seed", range(10))
def test_generated_lists_are_indented(seed):
    rng = random.Random(seed)

    def make(depth):
        return [(f"t{rng.randrange(99)}", make(depth + 1) if depth < 3 and rng.random() < 0.4 else []) for _ in range(rng.randint(1, 4))]

    def page(items, depth=0):
        tag = "ol" if depth % 2 else "ul"
        return f"<{tag}>" + "".join(f"<li>{text}" + (page(inner, depth + 1) if inner else "") for text, inner in items) + f"</{tag}>"

    items = make(0)
    assert render(page(items)).split("\n") == brute_list(items)


def test_preformatted_lines_go_on_across_elements():
    assert render("<pre>one <b>two</b> three\n  <i>four</i>\n\nfive</pre>six") == "one two three\n  four\n\nfive\n\nsix"
    assert render("a<pre>\nx\n y\n</pre>b") == "a\n\nx\n y\n\nb"


def test_spans():
    page = "<table><tr><th colspan=2>both<th>n<tr><td rowspan=2>a<td>b<td>1<tr><td>c<td>2<tr><td colspan=x>d<td rowspan=0>e<td>3</table>"
    assert render(page) == "both  n\na  b  1\n   c  2\nd  e  3"
    assert render("<table><tr><td colspan=99999999999>a<td>b</table>") == "a  b"


def test_drawings_and_formulas():
    page = "<p>see <svg><title>t</title><desc>d</desc><text>axis</text><text>label</text></svg>"
    page += "<math><mi>x</mi><mo>+</mo><mn>1</mn><annotation>x+1</annotation></math>"
    assert render(page) == "see\naxis\nlabel\nx+1"
