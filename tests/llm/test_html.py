import numpy as np
import pytest

from lexiloom.llm import html_extract as X
from lexiloom.llm.html_pages import labelled_pages
from lexiloom.llm.html_tree import Trees

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of today</a></li></ul></nav><!-- ad --><div class="ad">Buy this now. It is cheap.</div>
<article><h1>A title &amp; more</h1><p><b>First   paragraph of\n the text, which is long enough to be read.<br><p>Second &lt;paragraph&gt;,&nbsp;with an <a href=x>inner link</a> in it.</p>
<p>Third one is here as well, and it says a few more words.</p></article><footer>&copy; site &middot; All rights are reserved here.</footer>"""
TEXT = "A title & more\n\nFirst paragraph of the text, which is long enough to be read.\n\nSecond <paragraph>, with an inner link in it.\n\nThird one is here as well, and it says a few more words."


def test_page():
    assert X.main_texts([PAGE, None, "", PAGE], X.trained()) == [TEXT, "", "", TEXT]


def test_held_out_pages():
    trees = Trees()
    for p in labelled_pages(150, seed=11):
        trees.add(p)
    g = X.Graph(trees)
    odds = g.marginals(*X.trained())
    runs = np.array(sorted(trees.texts))
    right = (odds[runs] > 0) == g.label[runs]
    assert right.mean() > 0.97


def brute(x, parent, edge, w, tables):
    """Marginals by summing over all labellings."""
    n = len(parent)
    total = np.zeros((n, 2))
    for code in range(1 << n):
        y = [(code >> i) & 1 for i in range(n)]
        s = sum((x[i] @ w) * y[i] for i in range(n)) + sum(tables[edge[i]][y[parent[i]], y[i]] for i in range(n) if parent[i] >= 0)
        for i in range(n):
            total[i, y[i]] += np.exp(s)
    return np.log(total[:, 1] / total[:, 0])


@pytest.mark.parametrize("page", ["<div><p>a b</p><ul><li>c</ul></div>d", "x<p>y", "<nav>q<a href=z>w</a></nav>"])
def test_messages_give_the_marginals(page):
    trees = Trees()
    trees.add(page)
    g = X.Graph(trees)
    rng = np.random.default_rng(3)
    w, tables = rng.normal(size=g.x.shape[1]), rng.normal(size=(X._N_KINDS**2, 2, 2))
    assert np.allclose(g.marginals(w, tables), brute(g.x, g.parent, g.edge, w, tables))


def test_gradient_leads_to_the_labels():
    pages = ['<body><div data-content="1"><p>aa bb cc.</p></div><nav data-content="0">xx</nav></body>'] * 5
    w, e = X.fit(pages, rounds=80)
    trees = Trees()
    trees.add(pages[0])
    g = X.Graph(trees)
    assert ((g.marginals(w, e) > 0) == g.label).all()


def runs(page):
    trees = Trees()
    trees.add(page)
    return [(trees.block[i], t) for i, t in trees.texts.items()]


def test_tolerant_parsing():
    assert [t for _, t in runs("<p>a<p>b</div>c")] == ["a", "b", "c"]
    assert [t for _, t in runs("<p title='x>y'>a</p><p don't>b</p>")] == ["a", "b"]
    assert [t for _, t in runs("<script>if (a<b) '</p>'</script>a<!-- no > --> b<style>x")] == ["a b"]
    assert [t for _, t in runs("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>")] == ["a", "b", "c", "d"]
    assert [t for _, t in runs("<table><tr><td>a<td>b<tr><td>c</table>")] == ["a", "b", "c"]
    assert [t for _, t in runs("a < b & c <")] == ["a < b & c <"]
    assert [t for _, t in runs("text <a href='cut off")] == ["text "]
    assert [t for _, t in runs("&eacute;&#233;&#xe9;&amp")] == ["ééé&"]
    blocks = [b for b, _ in runs("<p>a <span class='ad'>b</span> c</p>")]
    assert len(set(blocks)) == 1
    deep = runs("<div>" * 20_000 + "x" + "</div>" * 20_000)
    assert [t for _, t in deep] == ["x"]
    long = "<p>" + "word " * 400_000
    assert len(X.main_texts([long], X.trained())[0]) == 5 * 400_000 - 1


def test_query_on_awkward_rows(spark, tmp_path):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "", ""), (None, "n", "<p>   </p>"), (4, "v", "\0<\x01>&#0;&#xD800;"), (5, "w", "no markup at all, just a line of text.")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS _html", "4 AS _c0")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = X.query(spark, str(tmp_path))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got.collect()))
    assert len(out) == len(rows) and [x[1] for x in out if x[0] == 1] == [TEXT, TEXT]
    assert all(len(t) == n for _, t, n in out) and out[0][1] == "" and (2, "", 0) in out and (3, "", 0) in out
    assert X.extract(df.limit(0), ["page_id"]).count() == 0


def test_time_is_linear_in_hostile_pages():
    import time

    from lexiloom.llm.html_tree import Trees

    makers = [lambda n: '<a b="' * n, lambda n: '<a b="' * n + ">", lambda n: "<a b='>\" c=" * n, lambda n: "<!x " * n, lambda n: "<script>" + "</script " * n, lambda n: "<div>" * n + "</p>" * n, lambda n: "<b>" * n + "</i>" * n]
    for make in makers:
        page = make(1)
        page = make(1_000_000 // len(page))
        began = time.process_time()
        Trees().add(page)
        assert time.process_time() - began < 20, page[:40]
