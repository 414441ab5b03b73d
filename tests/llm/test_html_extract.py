import itertools
import math

import numpy as np
import pytest

from wanderrank.llm import html_extract as H

PAGE = ("<!DOCTYPE html><html><head><title>T {0}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/a'>Home {0}</a></li><li><a href='/b'>News</a></li></ul></nav><!-- ad {0} -->"
        "<div class='ad'>Buy thing number {0} now.</div><article><h1>Title {0} &amp; more</h1>"
        "<p><b>First  sentence\n of {0}.<br><p>A longer paragraph, with commas, about item {0}. It has two sentences.</p>"
        "<p>Short.</p></article><footer>&copy; site {0}</footer>")


@pytest.fixture(scope="module")
def model():
    return H.fit_pages(H.labelled_pages([PAGE.format(i) for i in range(60)]))


def test_page_text(model):
    got = H.extract(PAGE.format(777), model)
    assert got == ("Title 777 & more\nFirst sentence of 777.\nA longer paragraph, with commas, about item 777. "
                   "It has two sentences.\nShort.")


def test_held_out_leaf_accuracy_without_semantic_tags(model):
    right = total = 0
    for k in range(200, 260):
        source, content = H.plain_variant(PAGE.format(k), k)
        p = H.parse(source)
        q = model.marginals(p)
        for i in p.leaves():
            right += (q[i] > 0.5) == (i in content)
            total += 1
    assert right >= 0.97 * total


def test_sum_product_is_exact():
    rng = np.random.default_rng(2)
    parent, kind = [-1, 0, 0, 1, 1, 2, 4], [0, 0, 1, 2, 1, 2, 2]
    unary, pair = rng.standard_normal(7), rng.standard_normal((3, 2, 2))
    got = H.sum_product(parent, kind, unary, pair)
    mass, on = 0.0, np.zeros(7)
    for y in itertools.product((0, 1), repeat=7):
        w = math.exp(sum(u * v for u, v in zip(unary, y)) + sum(pair[kind[i]][y[parent[i]]][y[i]] for i in range(1, 7)))
        mass += w
        on += w * np.array(y)
    assert np.allclose(got, on / mass, atol=1e-9)


def test_parser_edges():
    texts = lambda s: [H.parse(s).text[i] for i in H.parse(s).leaves()]
    assert texts("a &lt;b&gt; &#x41;&#66; &amp c&nbsp;d") == ["a <b> AB & c d"]
    assert texts("<p>one<p>two<div>three</div>four") == ["one", "two", "three", "four"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("x<!-- hidden <p>no</p> --> y<script>if (a<b) '</p>'</SCRIPT >z<style>never closed") == ["x yz"]
    assert texts("a < b <3 c<br>d<br/>e") == ["a < b <3 c d e"]
    assert texts("<p title='a > b' class=x>t</p></p></div>u") == ["t", "u"]
    assert texts("<td>1<td>2<tr><td>3") == ["1", "2", "3"]
    assert texts("") == [] and texts("<!--") == [] and texts("<") == ["<"] and texts("<p") == []


def test_depth_and_length_are_linear(model):
    H.extract("<div>" * 3_000 + "deep" + "</div>" * 3_000, model)
    H.extract("<p " + "a='" * 5_000, model)
    H.extract("<" * 20_000, model)
    H.extract("<p>" + "word " * 200_000, model)


def test_contract(spark):
    rows = [(i, f"u{i}", PAGE.format(i)) for i in range(40)] + [(None, None, None), (50, "e", ""), (51, "t", "<p>"), (3, "u3", PAGE.format(3))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = H.extract_pages(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = got.collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id in (None, 50, 51)} == {""}
    assert all(r.text.startswith(f"Title {r.page_id} & more\n") and r.text.endswith("Short.") for r in out if r.page_id is not None and r.page_id < 50)
    assert H.extract_pages(df.limit(0)).count() == 0
