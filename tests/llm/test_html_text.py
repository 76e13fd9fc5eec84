from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest

from gridloom.llm import catalog, html_text
from gridloom.llm.html_text import visible_text


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""), ("plain  text\n here", "plain text here"), ("a<br>b<br/>c", "a\nb\nc"),
        ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>", "a\nb"),
        ("<b>un<i>closed</b> tail", "unclosed tail"), ("x</p>y", "x\n\ny"), ("a < b & c &lt; d", "a < b & c < d"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "• a\n• b\n  3. x\n  4. y\n• c"),
        ("<ul><li>a<ul><li>b</ul></ul>", "• a\n  ◦ b"),
        ("<table><tr><td>one<td>two two<tr><td>three three<td>4</table>", "one          two two\nthree three  4"),
        ("<table><td>a<td>b<tr><td colspan=2>wide cell<tr><td>c<td>d</table>", "a  b\nwide cell\nc  d"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<table><caption>cap</caption><tr><th>h<tr><td><table><tr><td>in<td>ner</table></table>after",
         "cap\nh\nin  ner\n\nafter"),
        ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
        ("<h1>T</h1>x<hr>y", "T\n\nx\n\ny"), ("<h1>a<h2>b", "a\n\nb"),
        ("<div hidden>no<p>no</div>yes", "yes"), ("<p style='color:red; display : none'>no</p>yes", "yes"),
        ("<style>.x, p#q {display:none} b{color:red}</style><i class='a x'>no</i><p id=q>no</p><b>yes</b>", "yes"),
        ("<script>if (a<b) '</p>'</script>a<!-- no --><style>p{}</style>b<title>t</title>", "ab"),
        ("<template><p>no</template><noscript>no</noscript>yes", "yes"),
        ("<details>no<summary>s</summary><p>no</details><details open><summary>t</summary>u</details>", "s\nt\nu"),
        ("<select><option>a<option>b</select>", "a\nb"), ("<textarea>\n<p> x</textarea>", "<p> x"),
        ("<dl><dt>T<dd>D<dd>E</dl>", "T\n    D\n    E"), ("<blockquote>q<p>r</blockquote>", "> q\n\n> r"),
        ("<input type=submit value='Go'><input value='a  b'><input type=hidden value=no>c", "Go a b c"), ("a&nbsp;&nbsp;b", "a  b"),
        ("<p title='a>b'>x", "x"), ("<a href=x>1<a href=y>2", "12"), ("<body hidden>no", ""), ("<li>a<li>b", "• a\n• b"),
        ("<table><tr><td>a<td rowspan=2>b<tr><td>c<tr><td>d<td>e</table>", "a  b\nc\nd  e"),
        ("<table><tr><td rowspan=3>a<td>b<tr><td>c<tr><td>d<tr><td>e<td>f</table>", "a  b\n   c\n   d\ne  f"),
        ("<b>x<p>y</b>z</p>w", "x\n\nyz\n\nw"), ("<i>a<ul><li>b</i>c</ul>d", "a\n\n• bc\n\nd"),
        ("a<span style='display:block'>b</span>c", "a\nb\nc"), ("<style>.l{display:flex}</style>a<a class=l>b</a><a class=l>c</a>", "a\nb\nc"),
        ("<input placeholder='your name'><input type=password value=no><input type=submit>", "your name"),
        ("<style>.a{display:none !important} #i{display:block}</style><p id=i class=a style='display:block'>no</p>yes", "yes"),
        ("<style>p{display:none !important} p{display:block}</style><p style='display:block!important'>yes</p><p>no", "yes"),
        ("<style>.a.b{display:none}</style><i class='a'>x</i><i class='b c a'>no</i>", "x"),
        ("<style>.nav .c{display:none}</style><div class=nav><p><i class=c>no</i>x</div><i class=c>y</i>", "x\n\ny"),
        ("<style>div>p.c, ul > li > i{display:none}</style><div><p class=c>no</p><b><p class=c>x</p></b></div><ul><li><i>no</i>y</ul>", "x\n\n• y"),
        ("<style>p:hover{display:none} [x]{display:none} p+p{display:none}</style><p x>a<p>b", "a\n\nb"),
        ("<table><tr><td>漢字<td>x<tr><td>abc<td>y<tr><td>e\u0301e<td>z</table>", "漢字  x\nabc   y\ne\u0301e    z"),
        ("t<!-- open", "t"), ("<p", "<p"), ("</table></td></tr>a", "a"), ("<tr><td>a", "a"),
    ],
)
def test_layout(page, want):
    assert visible_text(page) == want


class Words(HTMLParser):
    """Words of a page outside what is never shown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.words += data.split()


def test_query_keeps_every_visible_word(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = catalog.op3_html_text(spark, sf).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        reader = Words()
        reader.feed(pages[r.page_id])
        reader.close()
        assert "".join(re.sub(r"[•◦▪]", "", r.text).split()) == "".join(reader.words)
        assert r.n_lines == len(r.text.split("\n"))


def test_odd_rows(spark):
    deep = "<div><ul><li><b>" * 20_000 + "x"
    pages = [(1, "<p>a", "u"), (1, "<p>a", "u"), (None, None, None), (3, "", "u"), (4, deep, "u"), (5, "<p>é" * 50_000, "u"),
             (6, "<td>" * 3000 + "</b>" * 3000, "u"), (7, "<a '\">" * 5000, "u")]
    frame = spark.createDataFrame(pages, "page_id bigint, html string, text string")
    out = html_text.extract_text(frame)
    assert sorted(out.columns) == sorted(frame.columns)
    got = {r.page_id: r.text for r in out.collect()}
    assert got[1] == "a" and got[None] is None and got[3] == "" and got[4].endswith("x") and got[5].count("é") == 50_000
    assert out.count() == len(pages) and html_text.extract_text(frame.limit(0)).count() == 0
