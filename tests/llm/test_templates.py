"""Main text of pages: what is article, what is template, broken markup."""

import random

import pytest

from arborist.llm import templates

PAGES = "page_id long, url string, html string"


def text_of(source):
    found, _ = templates.region(templates.parse(source))
    return " ".join("".join(t for t, _ in found).split())


@pytest.mark.parametrize("source, want", [
    ("<article><h1>A</h1><p>one<p>two</article>", "A one two"),
    ("<article><p>fo<b>o</b> <i>bar</i>\n\t baz<br>qux</p></article>", "foo bar baz qux"),
    ("<article><p>a &amp;&amp; b &lt;i&gt; &#233; &#x41; &nbsp; c</article>", "a && b <i> é A c"),
    ("<p>a</p><script>var t='</p><p>no'</script><p>b<style>p{x}</style>", "a b"),
    ("<header><h1>Site</h1></header><main><header><h1>T</h1></header><p>x</p><footer>f</footer></main><footer>g</footer>", "T x"),
    ("<nav><ul><li>m</ul></nav><div class='side-bar sidebar'>s</div><p>x</p><form>f<input></form>", "x"),
    ("<article>x<div class='comment-list'>c</div><section id=comments>d</section><aside>e</aside>y</article>", "x y"),
    ("<div class=ad>a</div><div class='cookieNotice'>c</div><div role=navigation>n</div><div class=adage>k</div>", "k"),
    ("<body class='with-sidebar'><div class='has-comments'><p>x</p></div>", "x"),
    ("<div class='page-header'>h</div><article><div class='header'>t</div>x</article>", "t x"),
    ("<div class=widget><article>x</article></div>", "x"),
    ("<article>x</article><div class=related><article>y</article></div>", "x"),
    ("<article>one</article><p>between</p><article>two</article>", "one two"),
    ("<p>a<!-- <p>no</p> -->b<!-- open <p>c", "ab"),
    ("<p title='a>b'>x</p><p data-x=it's>y</p><P CLASS=\"Ad\">z</P>", "x y"),
    ("a < b and c > d <", "a < b and c > d <"),
    ("text <p", "text"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
    ("</p></div>x</b>", "x"),
    ("<textarea><p>no</textarea><title>t</title><p>x", "x"),
    ("<SCRIPT>no</SCRIPT>x<script>never ends <p>y", "x"),
    ("<p>x<div hidden>no</div><div style='display: none'>no</div>", "x"),
    ("", ""), ("   \n", ""), ("<html></html>", ""), ("plain", "plain"),
])
def test_main_text(source, want):
    assert text_of(source) == want


def test_subtree_hashes_follow_tags_and_texts():
    page = templates.parse("<div><p>a <b>x</b></p></div><div class=k><p> a <b>x</b> </p></div><div><p>a x</p></div><ul><p>a <b>x</b></p></ul>")
    by = {}
    for tag, h in zip(page.tag, page.hash):
        by.setdefault(tag, []).append(h)
    assert by["div"][0] == by["div"][1] != by["div"][2]
    assert by["p"][0] == by["p"][1] == by["p"][3] != by["p"][2]
    assert by["ul"][0] not in by["div"]
    deep = templates.parse("<div>" * 30_000 + "x")
    assert len(deep.tag) == 30_001 and all(deep.hash[1:])


def brute(rows, min_pages=5, share=0.2, article_share=0.5):
    """The same deletions from lists and sets."""
    read = []
    for page_id, url, source in rows:
        pieces, marked = templates.region(templates.parse(source or ""))
        host = (url or "").split("://", 1)[1].split("/")[0].lower() if "://" in (url or "") else ""
        read.append((page_id, url, host, pieces, marked))
    seen = {}
    for _, _, host, pieces, marked in read:
        seen.setdefault((host, marked), {})["".join(t for t, _ in pieces)] = {h for _, above in pieces for h in above}
    out = []
    for page_id, url, host, pieces, marked in read:
        pages = seen[host, marked].values()
        least = max(min_pages, (article_share if marked else share) * len(pages))
        gone = lambda h: sum(h in p for p in pages) >= least  # noqa: B023, E731
        kept = " ".join("".join(" " if any(gone(h) for h in above) else t for t, above in pieces).split())
        out.append((page_id, url, kept, len(kept)))
    return sorted(out, key=repr)


@pytest.fixture
def site():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(90):
        host = "hot.example.org" if i < 60 else f"h{i % 3}.example.org"
        lead = f"<div>Welcome to {host}<ul><li>one</li><li>two</li></ul></div>"
        some = "<p>Seen on some pages</p>" if i % 4 == 0 else ""
        body = f"<p>{prose(12)}</p>{some}<p>{prose(20)} &eacute;</p>"
        if i % 3 == 0:
            body = f"<article>{body}<p>Read more from us</p></article>"
        rows.append((i, f"http://{host}/{i}", f"<html><body>{lead}{body}<div>All rights {host}</div></body></html>"))
    copy = f"<body><p>{prose(30)}</p><p>{prose(10)}</p></body>"
    rows += [(200 + i, f"http://H0.example.org/c{i}?x", copy) for i in range(40)]  # an article copied
    rows += [(300, None, "<p>x y</p>"), (301, "no host", "<p>x y</p>"), (302, "http://hot.example.org/", None), (303, "", "")]
    rows += [(None, "http://one.example.org", "<p>alone</p>"), (5, "http://one.example.org", "<p>again</p>"), (5, "http://one.example.org", "<p>again</p>")]
    rows += [(400, "http://hot.example.org/long", "<p>" + "<b>long</b> text</p><p>" * 20_000)]
    return rows


def test_templates_of_a_host_go(spark, site):
    df = spark.createDataFrame(site, PAGES)
    for clash in ("host", "text", "page", "pieces", "marked", "weak", "strong", "n_chars"):
        df = df.withColumn(clash, df["page_id"])
    got = templates.extract(df.repartition(5))
    rows = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got.collect()), key=repr)
    assert rows == brute(site)
    by = {r[0]: r[2] for r in rows}
    assert not any(w in t for w in ("Welcome", "All rights", "one two") for i, t in by.items() if i is not None and i < 60)
    assert all("Read more" not in by[i] for i in range(0, 60, 3))
    assert by[200] and by[302] == "" and by[400].count("long") == 20_000


def test_joined_without_a_broadcast(spark, site, monkeypatch):
    monkeypatch.setattr(templates, "bounded", lambda df, *_: df)
    got = templates.extract(spark.createDataFrame(site, PAGES))
    assert sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got.collect()), key=repr) == brute(site)


def test_empty_table(spark):
    assert templates.extract(spark.createDataFrame([], PAGES)).count() == 0
