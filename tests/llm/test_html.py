import random
import re

import pytest
from conftest_llm import rows_of

from fieldtrail.llm.html import extract, render

CASES = {
    "implied ends": ("<p>One<p>Two <b>bold</b>x<div>d1</div>tail<br>z", "One\n\nTwo boldx\n\nd1\ntail\nz"),
    "nested lists": (
        "<ul><li>a<li>b<ol start=3><li>n1<li value=9>n2<li>n3</ol><li>c</ul>end",
        "- a\n- b\n  3. n1\n  9. n2\n  10. n3\n- c\n\nend",
    ),
    "table in columns": (
        "<table><caption>Cap</caption><tr><th>Name<th>Age<tr><td>Al<td>30<tr><td>x<td>y</table>after",
        "Cap\nName  Age\nAl    30\nx     y\n\nafter",
    ),
    "spans": ("<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td colspan=2>w<td>q</table>", "r  1\n   2\nw     q"),
    "table in a cell": ("<table><tr><td><table><tr><td>a<td>b<tr><td>c<td>d</table><td>e</table>", "a  b  e\nc  d"),
    "text between cells": ("<table>stray<tr><td>c</table>", "stray\n\nc"),
    "hidden by rule": (
        "<style>/* x */ .h, i {display:none} @media print { p {display:none} } #v{visibility:hidden}</style>"
        "<p class='a h'>no</p><p id=v>no<span style='visibility:visible'>yes</span></p><i>no</i><p>shown",
        "yes\n\nshown",
    ),
    "hidden by attribute": (
        "<p hidden>no</p><div style='DISPLAY : none !important'>no<p>no</div>ok<details><summary>S</summary>no</details>"
        "<details open><summary>T</summary>in</details><dialog>no</dialog><template>no</template>",
        "ok\nS\nT\nin",
    ),
    "raw text": ("<script>var t='</p>';</script>a<SCRIPT>if (a<b) x</script >b<noscript>no</noscript>", "ab"),
    "preformatted": ("<pre>a  b\n   c\n\nd</pre>x", "a  b\n   c\n\nd\n\nx"),
    "signs": ("x &lt;tag&gt; 1 < 2 &amp; <!-- c > --><a href='x>y'>link</a>&nbsp;.<![CDATA[no]]>", "x <tag> 1 < 2 & link ."),
    "definitions": ("<dl><dt>t<dd>d<dt>t2<dd>d2</dl>", "t\n  d\nt2\n  d2"),
    "choices": ("<select><option>o1<option>o2</select><textarea>a<b></textarea>", "o1\no2\na<b>"),
    "broken": ("a<p", "a"),
    "unclosed": ("<div><span>a</div>b</span></p>c", "a\nb\n\nc"),
    "spaces": ("  a \n\t b <b> c</b> <i>d </i> e<p>  ", "a b c d e"),
}


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    page, want = CASES[name]
    assert render(page)[1] == want


def test_title():
    assert render("<html><head><title>T &amp;\n x</title><body>b")[0] == "T & x"
    assert render("<title>T<p>b</title>c") == ("T<p>b", "c")


def test_all_visible_words_in_order():
    """Any tree: each visible word is there once, in the order of the page, and no hidden one is."""
    rng = random.Random(12)
    tags = "div p b i span ul ol li blockquote section h2 em a pre article dl dt dd".split()
    number = [0]

    def grow(depth, hidden):
        out = []
        for _ in range(rng.randrange(1, 4)):
            number[0] += 1
            out.append(f" {'h' if hidden else 'v'}{number[0]} ")
            if depth < 6:
                off = rng.random() < 0.1
                tag = rng.choice(tags)
                # Where end tags are implied, a hidden element may end early: those are left out here.
                tag = "span" if off else tag
                mark = rng.choice([" hidden", " style='display:none'"]) if off else ""
                inside = grow(depth + 1, True) if hidden or off else grow(depth + 1, False)
                inside = re.sub(r"<[^>]*>", "", inside) if off else inside
                out.append(f"<{tag}{mark}>{inside}</{tag}>")
        return "".join(out)

    for _ in range(60):
        page = grow(0, False)
        assert render(page)[1].split() and re.findall(r"[vh]\d+", render(page)[1]) == re.findall(r"v\d+", page)


def test_cells_stand_in_columns():
    rows = [["a", "bb", "c"], ["dddd", "e", "ff"], ["g", "h" * 100, "i"]]
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in r) for r in rows) + "</table>"
    lines = render(page)[1].split("\n")
    assert [re.split(r" {2,}", line) for line in lines] == rows
    assert lines[0].index("bb") == lines[1].index("e") == 6


@pytest.mark.parametrize("page", ["<div>" * 30_000 + "deep", "<table><tr><td>" * 2_000 + "deep", "<p>" * 50_000 + "deep", "<b" * 90_000, "<" * 90_000, "<a '" * 50_000])
def test_odd_nesting_is_quick(page):
    text = render(page)[1]
    assert "deep" not in page or text == "deep"


def test_table_of_pages(spark):
    schema = "page_id long, url string, html string, title string, text int"
    rows = [(1, "u", "<p>x", "t", 1), (None, None, None, "t", 1), (2, "u", "", "t", 1), (2, "u", "", "t", 1)]
    got = rows_of(extract(spark.createDataFrame(rows, schema)))
    assert sorted((str(r.page_id), r.url, r.title, r.text) for r in got if r.url) == [("1", "u", "", "x"), ("2", "u", "", ""), ("2", "u", "", "")]
    assert len(got) == 4 and rows_of(extract(spark.createDataFrame([], schema))) == []
