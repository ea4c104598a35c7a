"""Wrappers of web pages: folding, alignment, verdicts and whole tables."""

import html
import json
import re

from llm_fixtures import *  # noqa: F403
from llm_fixtures import SF, clash

from rollcall.llm import page_wrappers as P
from rollcall.llm import queries

PAGES = "page_id bigint, url string, html string"


def wrapper(pages):
    read, found = P.Reader(), None
    for p in pages:
        found = P.merged(found, P.item_of(read(p)))
    return found


def texts(pages):
    along = P.Wrapper(json.dumps(P.judged(wrapper(pages))))
    return ["\n\n".join(along.blocks(P.Reader()(p))) for p in pages]


def shape(item):
    inner = "".join(map(shape, item[P.KIDS]))
    own = f"({inner})" if item[P.NAME] == "+" else item[P.NAME].split("|")[0] + (f"[{inner}]" if inner else "")
    return own + ("+" if item[P.REPEATED] else "") + ("?" if item[P.OPTIONAL] else "")


def test_repetitions_fold_and_mismatches_become_optional():
    a = "<div><h1>t</h1><p>a</p><p>b</p></div>"
    b = "<div><h1>u</h1><p>c</p><table><tr><td>x</td></tr></table></div>"
    assert shape(wrapper([a])) == "page[div[h1[#]p[#]+]]"
    assert shape(wrapper([a, b])) == "page[div[h1[#]p[#]+table[tr[td[#]]]?]]"
    assert shape(wrapper([b, a])) == shape(wrapper([a, b]))
    pairs = "<dl><dt>a</dt><dd>1</dd><dt>b</dt><dd>2</dd></dl>"
    once = "<dl><dt>a</dt><dd>1</dd></dl>"
    assert shape(wrapper([pairs])) == "page[dl[(dt[#]dd[#])+]]"
    assert shape(wrapper([pairs, once])) == shape(wrapper([once, pairs])) == shape(wrapper([pairs]))
    # What one page lacks in the middle is found by the cross search.
    assert shape(wrapper(["<h1>a</h1><p>b</p>", "<h1>a</h1><hr><ul><li>x</ul><p>c"])) == "page[h1[#]ul[li[#]]?p[#]]"


def test_slots_vary_and_template_does_not():
    found = wrapper(["<p>same</p><div>a</div>", "<p>same</p><div>b</div>"])
    p, div = found[P.KIDS]
    assert p[P.KIDS][0][P.HASH] is not None and div[P.KIDS][0][P.HASH] is None


def test_tag_soup():
    read = P.Reader()
    for page, want in (
        ("<p><b>one<br>two<p>three</b>", ["one two", "three"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<div>a</p>b</span></div>c<", ["a", "b", "c<"]),
        ("x < y &amp; z &lt;b&gt; &#233;&nbsp; q", ["x < y & z <b> é q"]),
        ("<script>if (a<b) '</p>'</script><p>t</p><style>p{}</style><!-- <p>no</p> -->", ["t"]),
        ("<P CLASS='x>y'>A<i>b</i>c</P><!-- open <p>no</p>", ["Abc"]),
        ("<p>cut <a href='x", ["cut"]),
    ):
        blocks = []

        def walk(node):
            for k in node[1]:
                blocks.append(k[0]) if isinstance(k, tuple) else walk(k)

        walk(read(page))
        assert blocks == want, page


MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/x'>Shop</a></li></ul></nav>"


def article_page(i, extra=""):
    body = "".join(f"<p>Sentence {j} of page {i}, <b>which</b> says what page {i} has to say.</p>" for j in range(1 + i % 4))
    return (
        f"<html><head><title>T{i}</title></head><body class='has-sidebar'><header><div>Site</div></header>{MENU}<div class='cookie-notice'>We use cookies</div>"
        f"<main><article><header><h1>Title {i}</h1></header>{body}<div class='ad-slot'>Buy {i}!</div>{extra}<form><label>Mail</label><input></form>"
        f"<section id='comments'><h3>Comments</h3><article class='comment'><p>Reader {i} says no.</p></article></section></article>"
        f"<aside><p>Related {i}</p></aside></main><footer>(c) {i}</footer></body></html>"
    ), [f"Title {i}", *(f"Sentence {j} of page {i}, which says what page {i} has to say." for j in range(1 + i % 4))]


def test_article_without_the_rest():
    pages = [article_page(i) for i in range(9)]
    assert texts([p for p, _ in pages]) == ["\n\n".join(w) for _, w in pages]
    pages = [article_page(i, "<ul><li>point</li><li>other</li></ul><pre>a\n  b</pre>" if i == 3 else "") for i in range(9)]
    want = [w + (["point", "other", "a b"] if i == 3 else []) for i, (_, w) in enumerate(pages)]
    assert texts([p for p, _ in pages]) == ["\n\n".join(w) for w in want]
    one, want = article_page(2)
    assert texts([one]) == ["\n\n".join(want)]


def test_pages_without_article_or_main():
    """Known only from the host's pages: what stands on all of them is template, links are a menu, the densest element is the text."""
    def page(i):
        return f"<div id='a'><div>Example Times</div><div>All rights in {2000}</div></div><div id='b'><ul>{''.join(f'<li><a href=x>Link {i} {k}</a></li>' for k in range(5))}</ul></div><div id='c'><div><h2>Head {i}</h2><p>{'words ' * 30}{i}</p><p>more of {i}</p></div></div><div id='d'>hint {i}</div>"

    pages = [page(i) for i in range(12)]
    assert texts(pages) == [f"Head {i}\n\n{'words ' * 30}{i}\n\nmore of {i}" for i in range(12)]


def test_notices_that_stand_on_all_pages():
    pages = [f"<article><h1>Same</h1><p>text {i}</p><div>Read our terms</div></article>" for i in range(20)]
    assert texts(pages) == [f"Same\n\ntext {i}" for i in range(20)]
    assert texts(pages[:1] * 20) == ["Same\n\ntext 0\n\nRead our terms"] * 20  # copies of one page tell nothing


def test_articles_in_a_form_and_lists_of_articles():
    pages = [f"<form><div class='sidebar'>s {i}</div><article><p>text {i} and more of it</p></article></form>" for i in range(4)]
    assert texts(pages) == [f"text {i} and more of it" for i in range(4)]
    pages = ["".join(f"<article><h2>{i} {k}</h2></article>" for k in range(3)) for i in range(4)]
    assert texts(pages) == ["\n\n".join(f"{i} {k}" for k in range(3)) for i in range(4)]


def test_wide_and_deep_pages_are_read_whole():
    wide = "<article>" + "".join(f"<div class='q{chr(97 + i % 26)}{chr(97 + i // 26)}'>d{i}</div>" for i in range(300)) + "</article>"
    assert texts([wide, "<article><p>p</p></article>"]) == ["\n\n".join(f"d{i}" for i in range(300)), "p"]
    deep = "<article>" + "<div>" * 3000 + "in" + "</div>" * 3000 + "<p>after</p></article>"
    assert texts([deep])[0].split("\n\n")[0] == "in"
    assert P.size(wrapper([f"<section class='q{chr(97 + i % 26)}{chr(97 + i // 26)}'><p>{i}</p><ul><li>x</ul></section>" * 2 for i in range(600)])) <= P.NODES


def article_of(page):
    """The plain article of the given tables' pages."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    parts = [re.sub("</?b>|<br>", "", p) for p in re.split("</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op11_page_wrappers(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article_of(pages[r.page_id].html), len(r.text))


def test_a_hot_host_is_merged_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(P, "FAN", 3)
    pages = [article_page(i) for i in range(40)]
    rows = [(i, "http://Hot.example/a?b" if i % 8 else f"http://h{i}.example", p) for i, (p, _) in enumerate(pages)]
    df = spark.createDataFrame(rows, PAGES).repartition(20)
    with P_conf(spark):
        found = {r.page_id: r.text for r in P.extract(df).collect()}
    assert found == {i: "\n\n".join(w) for i, (_, w) in enumerate(pages)}


def P_conf(spark):
    from rollcall.session import conf_scope

    return conf_scope(spark, spark__rollcall__hotKeyRowsPerTask=4, spark__sql__autoBroadcastJoinThreshold=-1)


def test_odd_pages(spark):
    page, want = article_page(1)
    rows = [(1, None, page), (2, "http://a.b", None), (3, "http://a.b", ""), (None, "http://a.b", page), (4, "no scheme", page), (5, "http://a.b", page), (5, "http://a.b", page), (None, None, None), (6, "http://long.x", "<article>" + "<p>word</p>" * 50_000 + "</article>"), (7, "http://t.x", "only text")]
    df = spark.createDataFrame(rows, PAGES)
    found = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in P.query(df).collect())
    text = "\n\n".join(want)
    plain = {1: text, None: text, 4: text, 5: text, 6: "\n\n".join(["word"] * 50_000), 7: "only text"}
    expected = [(str(i), str(u), plain.get(i, "") if h else "") for i, u, h in rows]
    assert found == sorted((i, u, t, len(t)) for i, u, t in expected)
    wider = P.query(clash(df)).collect()
    assert sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in wider) == found
    assert P.query(df.limit(0)).count() == 0
