"""HTML extraction: the table's own layout, planted site templates, odd markup."""
import html
import re

import pytest

from veilset.llm import templates as T

from .helpers import SF2, read


def plain(page):
    """The layout of the given tables, taken apart with two patterns."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark):
    got = {r["page_id"]: r for r in
           T.main_text(spark.read.parquet(f"{SF2}/pages.parquet")).collect()}
    for p in read(SF2, "pages"):
        want = plain(p["html"])
        assert got[p["page_id"]]["text"] == want
        assert got[p["page_id"]]["n_chars"] == len(want)
        assert got[p["page_id"]]["url"] == p["url"]


def site(host, n, body):
    return [(i, f"https://{host}/{i}", f"<html><body><div class=x><b>{host} daily</b><span>Tel. 1"
             f"</span></div>{body(i)}<p>Printed by {host}.</p></body></html>") for i in range(n)]


def run(spark, rows, p=T.Params()):
    df = spark.createDataFrame([(*r, "t", 1) for r in rows],
                               "page_id long, url string, html string, text string, host int")
    return sorted(map(tuple, T.main_text(df, p).collect()), key=repr)


def test_recurring_subtrees_go(spark):
    rows = site("a.example", 9, lambda i: f"<p>Story {i} of the day.</p>")
    rows += site("b.example", 3, lambda i: f"<p>Tale {i}.</p>")          # too few pages to tell
    got = run(spark, rows)
    for i in range(9):
        assert (i, f"https://a.example/{i}", f"Story {i} of the day.", len("Story 0 of the day.")) in got
    assert any("b.example daily" in r[2] and "Printed by b.example." in r[2] for r in got)


def test_hosts_are_apart_and_ports_and_users_are_not_host(spark):
    rows = [(i, u, "<p>Same words</p><div>more {i}</div>") for i, u in enumerate(
        ["http://u:p@H.example:80/1", "http://h.example/2?x", "//h.example/3", "http://h.example#4",
         "HTTP://h.EXAMPLE/5", "http://other.example/6"])]
    got = run(spark, rows)
    assert [r[2] for r in got][:5] == [""] * 5 and "Same words" in got[5][2]


def test_shared_article_text_stays(spark):
    rows = [(i, f"http://h.example/{i}", "<nav>Home</nav><article><p>One text.</p></article>")
            for i in range(12)]
    assert {r[2] for r in run(spark, rows)} == {"One text."}


def test_messy_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "", ""), (None, "x", "<p>a<p>b"),
            (3, "http://h/", "<article>" + "word " * 50_000), (4, "http://h/", "<p" * 3000),
            (5, "http://h/", "<div>" * 3000 + "deep" + "</b></i>"), (6, "u", "no markup &amp; all")]
    got = {(r[0], r[1]): r[2] for r in run(spark, rows)}
    assert len(run(spark, rows)) == len(rows)
    assert got[1, None] == "" and got[2, ""] == "" and got[None, "x"] == "a\n\nb"
    assert got[3, "http://h/"] == ("word " * 50_000).strip()
    assert got[4, "http://h/"] == "" and got[5, "http://h/"] == "deep"
    assert got[6, "u"] == "no markup & all"


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("page, want", [
    ("<article><p>a<b>b</b>c<p>d&nbsp;&lt;e&gt;<br>f</article>", "abc\n\nd <e> f"),
    ("<article><ul><li>x<li>y</ul>z</article>", "x\n\ny\n\nz"),
    ("<article>t<script>if (a < b) '</p>'</script><style>p{}</style>u</article>", "tu"),
    ("<article><p>a<!-- <p>no --></p><div id=comments><p>c</p></div></article>", "a"),
    ("<main><article><h1>T</h1>x</article><aside>s</aside></main><footer>f</footer>", "T\n\nx"),
    ("<header>h</header><div class='cookie-notice'>c</div><p>x</p><form>y</form>", "x"),
    ("<div role=navigation>m</div><table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<article><a title=\"x>y\" href='z'>k</a></article", "k"),
    ("<article><header><h1>Title</h1></header><div class=sidebar>s</div>t</article>", "Title\n\nt"),
    ("<article class='post ad-free'>kept</article>", "kept"),
    ("<p>a<div hidden>b</div>c", "a\n\nc"),
])
def test_markup(page, want):
    assert T.extract(T.parse(page)) == want


def test_templates_inside_articles_go(spark):
    """A box of neutral class in every article; copies and headings prove nothing."""
    rows = [(i, f"http://h.example/{i}", f"<body><article><h2>Summary</h2><p>Story {i}, <i>et al."
             f"</i></p><div class=box><p>Get our letter</p></div></article></body>")
            for i in range(8)]
    rows += [(100 + i, f"http://c.example/{i}", "<article><p>One text.</p><p>And more.</p>"
              "</article>") for i in range(9)]
    got = {r[0]: r[2] for r in run(spark, rows)}
    for i in range(8):
        assert got[i] == f"Summary\n\nStory {i}, et al."
    assert {got[100 + i] for i in range(9)} == {"One text.\n\nAnd more."}


def test_an_article_of_known_blocks_only_stays(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><p>Shared.</p>{f'<p>Own {i}.</p>' * (i > 0)}"
             "</article>") for i in range(8)]
    got = {r[0]: r[2] for r in run(spark, rows)}
    assert got[0] == "Shared." and got[3] == "Own 3."


def test_a_teaser_card_is_not_the_page():
    page = ("<body><article><h3>Read next</h3></article><div><h1>Title</h1><p>"
            + "main text " * 20 + "</p></div></body>")
    assert "main text" in T.extract(T.parse(page))
