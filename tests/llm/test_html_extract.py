import numpy as np
import pytest
from pyspark.sql import functions as F

from spindlekg.llm import html_extract as he


def text_of(page):
    return he.texts([page], he.train())[0]


@pytest.mark.parametrize("unknown, least", [(0.0, 0.99), (0.25, 0.98), (1.0, 0.94)])
def test_accuracy_on_pages_not_trained_on(unknown, least):
    """With names as they are on web pages, with a quarter of them made up, and with all made up."""
    made = [he._labelled(seed, unknown) for seed in range(100_000, 100_150)]
    forest, states = he.forest([t for t, _ in made]), np.concatenate([s for _, s in made])
    runs = [r[1] for r in forest.run]
    belief, _ = he.marginals(forest, *he.train())
    assert np.mean((belief[runs, 1] > 0.5) == (states[runs] == 1)) > least


def test_messages_give_exact_marginals():
    tree = he.parse("<div class=ad><p>a b<ul><li>c<li>d</ul></div>")
    f = he.forest([tree])
    rng = np.random.default_rng(0)
    weights, edges = rng.normal(size=(he.N_FEATURES, 2)), rng.normal(size=(len(he.GROUPS), 2, 2))
    n = len(f.parent)
    own = np.stack([np.bincount(f.node, weights=weights[f.feature, s], minlength=n) for s in (0, 1)], axis=1)
    total = np.zeros((n, 2))
    for code in range(2**n):
        x = [code >> i & 1 for i in range(n)]
        weight = np.exp(sum(own[i, x[i]] for i in range(n)) + sum(edges[f.group[i], x[f.parent[i]], x[i]] for i in range(n) if f.parent[i] >= 0))
        for i in range(n):
            total[i, x[i]] += weight
    belief, _ = he.marginals(f, weights, edges)
    assert np.allclose(belief, total / total.sum(axis=1, keepdims=True))


PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site. Accept them.</p></div>
<article><h1>The  &amp; title</h1><p>First&nbsp;paragraph of the <b>story</b>,<br>with&#33; more words.<p>Second one, which says a little more about it.
<ul><li>An item that is listed.<li>Another item that is listed.</ul><!-- a comment --></article>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>Other story</a></ul></aside>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with any of this.</p></div></section>
<form action=/s><label>Search</label><input name=q><button>Go</button></form>
<div class="ad">Buy this now. It is cheap.</div><footer>&copy; 2024 Someone</footer></body></html>"""


def test_article_without_the_rest():
    assert text_of(PAGE) == "The & title\n\nFirst paragraph of the story, with! more words.\n\nSecond one, which says a little more about it.\n\nAn item that is listed.\n\nAnother item that is listed."


def test_given_pages(spark):
    """The given pages' articles, cut out by their tags."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    found = he.texts([r.html for r in rows], he.train())
    for row, got in zip(rows, found, strict=True):
        article = row.html.split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</p></div>", "<html><body></body>", "<script>x", "<!-- open", "<div " + "x" * 10_000, "&amp", "<a href='" * 50, "<div>" * 3000 + "deep"])
def test_broken_pages(page):
    assert isinstance(text_of(page), str)


def test_plain_text_and_long_pages():
    words = "Words that are part of a long story, told at length. " * 20_000
    assert text_of(f"<article><p>{words}</p></article>") == " ".join(words.split())


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "u", "clash"), (2, "", None, "clash"), (3, PAGE, "u", "clash"), (3, PAGE, "u", "clash"), (None, PAGE, "u", None)], "page_id long, html string, url string, text string")
    keep = {"page_id": F.col("page_id"), "url": F.col("url")}
    found = he.extract(df, F.col("html"), keep).collect()
    assert len(found) == 5 and {r.n_chars for r in found if r.page_id in (1, 2)} == {0}
    assert len({r.text for r in found if r.page_id in (3, None)}) == 1
    assert he.extract(df.limit(0), F.col("html"), keep).count() == 0


IN_ARTICLE = "<html><body><article><h1>T</h1>{}</article></body></html>"


@pytest.mark.parametrize(
    "inner, want",
    [
        ("<p title=it's>First part of it.</p><p>Second, we don't know.</p><p>Third is here, too.</p>", ["First part of it.", "Second, we don't know.", "Third is here, too."]),
        ('<p class="x>First part of it.</p><p>Second, we know.</p>', ["First part of it.", "Second, we know."]),
        ("<p class='x>First part of it.</p><p>Second, we know.</p>", ["First part of it.", "Second, we know."]),
        ("<p title='a > b' data-x=\"1>2\" class=y>Fine text is here.</p><p a=b\"c>More text here.</p>", ["Fine text is here.", "More text here."]),
        ("<p =x>Odd one.</p><p a = 'b>c' d>Spaces around.</p><p a=>Nothing behind.</p>", ["Odd one.", "Spaces around.", "Nothing behind."]),
        ("<p>Say &<b>lt;</b> and &amp<b>;</b> and &am<!-- c -->p; here.</p>", ["Say &lt; and &; and &amp; here."]),
        ("<p>Cut in the middle of <b", ["Cut in the middle of"]),
        ("<p>Cut in an attribute.<a href='x y", ["Cut in an attribute."]),
        ("<p>One.</p></p></span></ul>Two is here.<p>Three.</p>", ["One.", "Two is here.", "Three."]),
    ],
)
def test_odd_tags_lose_no_text_and_leave_no_markup(inner, want):
    assert text_of(IN_ARTICLE.format(inner) if "Cut" not in inner else IN_ARTICLE.split("{}")[0].format() + inner) == "\n\n".join(["T", *want])


@pytest.mark.parametrize("name", ["seitenleiste", "commentaires", "fusszeile", "comentarios", "pie", "qwrtz"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_boxes_beside_the_article_in_any_language(name, tag):
    article = "<div class=inhalt><h1>Ein Titel</h1><p>Der erste Absatz, der etwas sagt. Noch ein Satz.</p><p>Der zweite Absatz, der mehr sagt. Und so weiter.</p></div>"
    box = f"<{tag} class={name}><p>Etwas anderes steht hier. Das ist nicht dabei.</p></{tag}>"
    want = "Ein Titel\n\nDer erste Absatz, der etwas sagt. Noch ein Satz.\n\nDer zweite Absatz, der mehr sagt. Und so weiter."
    assert text_of(f"<body>{article}{box}</body>") == want


@pytest.mark.parametrize("page", [lambda n: "<div>" * n + "</p>" * n + "x", lambda n: "<ul><li>" * n + "</td>" * n, lambda n: "<p a='" * n, lambda n: "<p " + "a=b " * n + ">x"])
def test_deep_and_broken_pages_take_time_in_proportion(page):
    import time

    took = []
    for n in (2_000, 16_000):
        start = time.perf_counter()
        text_of(page(n))
        took.append(time.perf_counter() - start)
    assert took[1] < 20 * took[0] + 1
