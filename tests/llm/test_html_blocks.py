"""Block reading, the LSTM's gradients, and extraction on pages with known main text."""

import html
import re

import numpy as np
import pytest

from convometrics.llm import html_blocks as hb
from convometrics.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def pages(spark):
    return {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}


@pytest.fixture(scope="module")
def model(pages):
    return hb.train([pages[i] for i in sorted(pages)[:150]])


def texts(page):
    return [t for _, t, _ in hb.blocks(page)]


def test_blocks():
    assert texts("a <b>b</b>\n\tc<p>d<p>e &amp; f&nbsp;g</p>") == ["a b c", "d", "e & f\xa0g"]
    assert texts("<script>var t='</p>';</script><style>x</style><!-- <p>no --><p>yes") == ["yes"]
    assert texts("<ul><li>1<li>2<ul><li>3</ul></ul><table><tr><td>4<td>5<tr><td>6</table>") == list("123456")
    assert texts("1 < 2 and <3<p>x</p") == ["1 < 2 and <3", "x"]
    assert texts("<p title='a > b'>t</p><p>&#233;&eacute;&amp &am") == ["t", "éé& &am"]
    assert texts("") == [] and texts("<p> \n </p>") == [] and texts("<!-- open") == [] and texts("<script>x") == []
    assert hb.blocks("<div class='Main content' id=x><p>t")[0][0] == ("div main content x", "p")
    assert texts("<head><title>t</title></head><body>b") == ["b"] and texts("<br>a<br/>b<hr>c") == ["a b", "c"]
    assert hb.blocks("<p>a <a href=x>link</a></p>")[0][2] == 4


def test_long_attributes():
    """A tag's attributes count whatever their length, and stray quotes cost no text."""
    state = "{'a': 'x > y', 'b': '<p class=menu>'}" * 1400
    assert len(state) > 50_000
    assert hb.blocks(f'<div class="comments" data-x="{state}" id=k><p>t</div><p>u') == [(("div comments k", "p"), "t", 0), (("p",), "u", 0)]
    long = "x" * 50_000
    assert hb.blocks(f"<p data-x='{long}' role=note>t</p>") == [(("p note",), "t", 0)]
    assert hb.blocks("<p title='it is > 1>t</p>") == [(("p",), "1>t", 0)]  # never closed
    assert hb.blocks('<p class="a>t</p><p class="b">u') == [(("p",), "t", 0), (("p b",), "u", 0)]
    many = "<p>t</p>" * 5000
    assert texts(f'<p class="a"">s</p>{many}<p class="b"">u') == ["s", *["t"] * 5000, "u"]
    assert texts('<p title="a > b" id=') == []
    assert len(texts('<p title=">" ' * 100_000 + "'>t")) == 1  # one scan


def test_skipped_elements_without_or_within_their_like():
    for tag in ("svg", "object", "select", "noscript", "math", "template", "iframe", "head"):
        assert texts(f"<p>one</p><{tag}><p>two</p><p>three</p>") == ["one", "two", "three"]
        assert texts(f"<p>one</p><{tag} a='x > y'><p>two</p></{tag}><p>three</p>") == ["one", "three"]
    for tag in ("svg", "object", "select", "math", "template"):
        assert texts(f"<{tag}>a<{tag}>b</{tag}>c</{tag}><p>d</p><{tag}><p>e") == ["d", "e"]
    assert texts("<p>one</p><script>two<p>three</p>") == ["one"]  # a script without an end takes the rest
    assert texts("<svg/><p>t</p>") == ["t"]
    assert len(texts("<svg><p>t</p>" * 20_000)) == 20_000  # one pass


def test_gradients_agree_with_differences():
    rnd = np.random.default_rng(1)
    net = hb.BiLstm(n=6, hidden=3)
    x, mask = hb.padded([rnd.normal(0, 1, (n, 6)).astype(np.float32) for n in (4, 2, 5)])
    x, y = x.astype(np.float64), rnd.integers(0, 2, mask.shape).astype(float)

    def loss():
        s = net.forward(x, mask)[0]
        return -(mask * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for k, w in net.w.items():
        at = 1 if w.ndim == 1 and len(w) > 1 else 0 if w.ndim == 1 else (1, 2)
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        down = loss()
        w[at] = old
        assert abs((up - down) / 2e-5 - grads[k][at]) < 1e-6, k


def truth(page):
    """Main text of the pages of the table: what stands in their article."""
    inner = re.sub(r"<[^>]*$", "", page[page.index("<article>") + 9 :].split("</article>")[0])
    parts = [re.sub(r"<[^>]+>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:h1|p)[^>]*>", inner)]
    parts = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(p)).strip(" ") for p in parts]
    return "\n".join(p for p in parts if p)


def test_pages_not_trained_on(pages, model):
    rest = [pages[i] for i in sorted(pages)[150:] if "<article>" in pages[i]]
    assert np.mean([hb.main_text(p, model) == truth(p) for p in rest]) >= 0.97


def test_other_layouts(model):
    page = (
        "<body><header><div>My Site</div><nav><a href=x>Home</a></nav></header><div class='cookie-banner'><p>We use cookies. Accept?</p></div>"
        "<main><h1>A big story</h1><p>The first paragraph of the story has words in it.</p><p>The second one goes on &amp; on, as such texts do.</p>"
        "<p>The last paragraph ends it all here.</p></main><section id=comments><h3>2 comments</h3><div class=comment><p>I liked this story a lot.</p></div>"
        "</section><form><label>Name</label><p>Leave a reply</p></form><footer><p>&copy; 2024</p></footer>"
    )
    got = hb.main_text(page, model)
    assert got == (
        "A big story\nThe first paragraph of the story has words in it.\nThe second one goes on & on, as such texts do.\nThe last paragraph ends it all here."
    )


def test_unseen_arrangements(pages, model):
    rnd = np.random.default_rng(5)
    right = total = 0
    parsed = [hb.blocks(pages[i]) for i in sorted(pages)[150:]]
    sentences = [t for p in parsed for _, t, _ in p]
    for p in parsed:
        main = [t for (_, t, _), y in zip(p, hb.rule_labels(p)) if y]
        others = [" ".join(s.split()[: rnd.integers(3, 40)]) for s in rnd.choice(sentences, 10)]
        page, labels = hb.variant(main, main[0][:60], others, rnd)
        found = hb.BiLstm.label(model, [hb.features([page])])[0]
        right += (found == labels).sum()
        total += len(labels)
    assert right / total >= 0.97


def test_query_shape_and_defined_cases(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "plain words", "x"), (3, "u", "<p>" * 3000 + "deep", "x"), (3, "u", "<p>" * 3000 + "deep", "x"), (4, "u", "<a \"" * 3000, "x")]
    got = hb.extract(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert len(got) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["text"] for r in got}[1] == "" and {r["page_id"]: r["text"] for r in got}[2] == ""
    assert hb.extract(spark.createDataFrame([], SCHEMA)).count() == 0
