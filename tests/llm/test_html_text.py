import html
import re

from polidata.llm import html_text as H
from polidata.llm import queries


def article(page):
    """The article's blocks of the given tables' one layout, by plain patterns."""
    body = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"<(?!br)[^>]*>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(shipped, sf, con):
    got = {r["page_id"]: r for r in queries.QUERIES["op3_html"](shipped, sf).collect()}
    for page_id, page in con.execute("SELECT page_id, html FROM pages").fetchall():
        assert got[page_id]["text"] == article(page) and got[page_id]["n_chars"] == len(article(page))


def test_held_out_labelled_pages():
    model, right, n = H.train(), 0, 0
    for page in map(H.Page, H.labelled_pages(80, seed=99)):
        labels = H.labels_of(page)
        for label, p, block in zip(labels, model.marginals(page), page.block):
            if block is not None:
                n, right = n + 1, right + ((p >= 0.5) == label)
    assert right / n > 0.97


def test_marginals_against_enumeration():
    import itertools
    import math
    model = H.train(30)
    page = H.Page("<div class=ad><p>x y</p></div><article><p>Some text here.</p><p>More.</p></article>")
    n = len(page.parent)
    total, on = 0.0, [0.0] * n
    for y in itertools.product((0, 1), repeat=n):
        e = sum(y[i] * sum(model.unary.get(f, 0.0) for f in page.features[i]) for i in range(n))
        e += sum(model.pair[page.edge[i]][y[page.parent[i]]][y[i]] for i in range(1, n))
        total += math.exp(e)
        on = [o + math.exp(e) * v for o, v in zip(on, y)]
    assert all(abs(p - o / total) < 1e-9 for p, o in zip(model.marginals(page), on))


def test_parts_of_pages():
    model = H.train()
    page = """<body><header class=site-header><p>Site name</p></header><div class="cookie-notice"><p>We use cookies.</p></div>
      <main><h1>Title &amp; more</h1><p>First <b>bold</b>
      text, with&nbsp;a <a href=x>link</a>.<br>Same block.<p>Second one is here.</p><form><p>Your mail</p><input></form>
      <div id=comments><p>I disagree with this.</p></div></main><aside><p>Read also</p></aside><footer>&copy; 2020</footer>"""
    assert H.main_blocks(page, model) == ["Title & more", "First bold text, with a link. Same block.", "Second one is here."]


def test_odd_pages(shipped):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>" + "<b>" * 3000 + "deep text."), (4, "u", "<script>var t='</p>';</script>"),
            (4, "u", "<article><p>This sentence was cut &am"), (5, "u", "<div>" * 20_000 + "x"), (6, "u", "<a \"" * 500)]
    pages = shipped.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in H.extract_text(pages).collect()]
    assert len(got) == len(rows) and got[0] == (1, "") and got[1] == (2, "") and got[2] == (None, "deep text.") and got[3] == (4, "") and got[4] == (4, "This sentence was cut &am")
    assert H.extract_text(pages.limit(0)).count() == 0


def test_text_after_unread_elements_is_read():
    def text(page):
        return " ".join(" ".join(x for x in H.Page(page).block if x).split())

    for inside in ("<select><option>A<option>B</select>", "<select><optgroup label=x><option>A<optgroup><option>B</select>", "<select><option>A</option><option>B</option></select>",
                   "<datalist><option>A<option>B</datalist>", "<svg/>", '<svg viewBox="0 0 1 1"/>', "<svg><path/><title/><g><style/></g></svg>", "<svg><title>A</title><path></svg>",
                   "<svg><svg/><g></svg>", "<button><span>A</button>", "<button><div>A</div></button>", "<select><option>A<select>", "<object><svg/><select><option>A</object>",
                   "<noscript><div>A</div></noscript>", "<template><p>A</template>", "<svg class=a/></svg>", "<svg><foreignObject><p>A</p></foreignObject></svg>", "<iframe>A</iframe>",
                   "<textarea><svg></textarea>", "<script>'<svg>'</script>"):
        assert text(f"<article><p>One {inside} two.</p><p>Three.</p></article>") == "One two. Three.", inside
    assert text("<article><div>One <svg><path></div><p>Two.</p></article>") == "One Two."
    assert text("<article><div>One <svg><path><p>Two.</p></div></article>") == "One Two."
    assert text("<article><div>One <button>A</div><p>Two.</p></article>") == "One Two."
    assert text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/></math> holds.<math/></p><p>Two.</p></article>") == "So x=1 holds. Two."
