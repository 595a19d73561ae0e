"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import inspect
import random
from collections import Counter
from itertools import combinations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationflow.llm import html, lines, mixing, packing, search, simhash, token_files, toxicity, urls, vectors

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "a very long text " * 40_000
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id string, row string, fp string, size string, copies string, h string, spans string, part string"
DOCS = [
    (1, "One line of five words\nand another line of words", "en", "b"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (None, "one  LINE of five words\nshort", "en", None),
    (4, LONG, "de", "a"),
    (5, "repeated row with some words", "en", "b"),
    (5, "repeated row with some words", "en", "b"),
    (5, "the same id and another text", "en", None),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, len(t or ""), *"abcdefgh") for i, t, g, s in DOCS]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


EVERY = Counter(d[0] for d in DOCS)


def test_toxicity(spark, docs, none, labels):
    out = toxicity.toxicity_scores(docs, labels)
    assert ids(out) == EVERY
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.collect())
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert toxicity.without_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.without_toxic(docs, labels.limit(0)).count() == len(DOCS)


def test_token_files(docs, none):
    out = token_files.token_digests(docs, PATH, 1).orderBy("start").collect()
    assert [r["doc_id"] for r in out] == [1, 2, 3, 4, 5, 5, 5, None, None]
    starts = [r["start"] for r in out]
    assert starts == [sum(r["n_tokens"] for r in out[:i]) for i in range(len(out))]
    assert [r["n_tokens"] for r in out if r["doc_id"] in (2, 3)] == [1, 1]
    assert token_files.token_digests(none, PATH, 1).count() == 0


def test_packing(docs, none):
    out = packing.packed_pieces(docs, PATH, 2).collect()
    assert Counter(r["doc_id"] for r in out).keys() == EVERY.keys()
    fill = Counter()
    for r in out:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) == 4096 and all(n & (n - 1) == 0 for n in fill.values())
    assert packing.packed_pieces(none, PATH, 2).count() == 0


def test_simhash(docs, none):
    out = simhash.simhash_components(docs)
    assert ids(out) == EVERY
    empty = [r for r in out.collect() if r["fingerprint"] == "0" * 16]
    assert len(empty) == 3 and {r["component_id"] for r in empty} == {2}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and ids(kept) == Counter([1, 2, None, 4, 5, 5])
    assert simhash.simhash_components(none).count() == 0 and simhash.one_of_each(none).count() == 0


def test_simhash_of_documents_without_an_id(spark):
    one = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "q r s t u v")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.simhash_components(one).collect()] == [None] * 3
    assert simhash.one_of_each(one).count() == 2


def test_lines(docs, none):
    out = {(r["doc_id"], r["text"]): r["n_removed"] for r in lines.line_report(docs, unit="line").collect()}
    assert out[1, DOCS[0][1]] == 0
    assert out[None, "short"] == 1
    assert out[5, ""] == 1 and out[3, None] == 0 and out[2, ""] == 0
    kept = lines.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(DOCS)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.where("text is not null").collect())
    assert lines.line_report(none).count() == 0 and lines.remove_repeats(none).count() == 0


def test_passages(spark, none):
    words = "a, b. " * 20
    rows = [(1, words), (2, f"own {words}"), (2, f"own {words}"), (None, words), (3, None), (4, ""), (5, " \n"), (6, "x, " * 60_000), (7, "short, text.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1)).withColumn("digest", F.lit("x")).repartition(3)
    out = Counter((r["doc_id"], r["text"] if r["text"] is None else r["text"][:8]) for r in lines.line_report(docs).collect())
    # the second row of document 2 has all its passages before; within a document the clauses that come first stay
    assert out == Counter({(1, "a, b. "): 1, (2, "own a, "): 1, (2, ""): 1, (None, ""): 1, (3, None): 1, (4, ""): 1, (5, " \n"): 1, (6, "x, "): 1, (7, "short, t"): 1})
    assert lines.remove_repeats(docs).columns == docs.columns


def test_mixing(docs, none):
    out = mixing.mix_report(docs).collect()
    assert Counter(r["doc_id"] for r in out) == EVERY
    assert all(r["taken"] <= 3 * r["size"] for r in out)
    assert {r["size"] for r in out if r["doc_id"] in (2, 3)} == {0}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixing.mix_report(none).count() == 0 and mixing.mix(none).count() == 0


def test_pages(spark):
    schema = "page_id long, url string, html string, text string, host string, rule string, label string, tokens string"
    pages = spark.createDataFrame(
        [
            (1, None, None, *"abcde"), (1, None, None, *"abcde"), (None, "no scheme", "", *"abcde"),
            (2, "http://", "<p>" * 20_000, *"abcde"), (3, "HTTP://EXAMPLE.org/en/1", "<article>a &amp; b", *"abcde"),
            (4, "http://example.org?x=1", "plain text", *"abcde"),
        ],
        schema,
    )
    text = {(r["page_id"], r["text"], r["n_chars"]) for r in html.main_text(pages).collect()}
    assert text == {(1, "", 0), (None, "", 0), (2, "", 0), (3, "a & b", 5), (4, "plain text", 10)}
    verdicts = [tuple(r) for r in urls.judge_urls(pages).collect()]
    assert Counter(verdicts) == Counter(
        [(1, "", "", None, "allow")] * 2
        + [(None, "", "", None, "allow"), (2, "", "", None, "allow")]
        + [(3, "example.org", "/en/1", "example.org/en/1", "block"), (4, "example.org", "", None, verdicts_of(verdicts, 4))]
    )
    assert html.main_text(pages.limit(0)).count() == 0 and urls.judge_urls(pages.limit(0)).count() == 0


def verdicts_of(rows, page_id):
    return next(r[4] for r in rows if r[0] == page_id)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [2.0, 0.0]), (None, [1.0, 0.0]), (100, None), (3, []), (4, [0.0, 0.0]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [1e-200, 1e-200]), (10, [3e38, 3e38]),
    ]
    table = spark.createDataFrame(
        [(i, v, "x", "y", "z") for i, v in rows], "vec_id long, embedding array<double>, row_id string, node string, dim string"
    )
    out = Counter(tuple(r) for r in vectors.near_duplicates(table).collect())
    assert out == Counter({
        (0, 3, 0, True): 2, (50, 3, 0, False): 1, (None, 3, 0, False): 1, (9, 1, 9, True): 1, (10, 1, 9, False): 1,
        **{(i, 0, i, True): 1 for i in (100, 3, 4, 5, 6, 7, 8)},
    })
    assert vectors.near_duplicates(table.limit(0)).count() == 0

    best = {}
    for r in search.top_k(table).collect():
        best.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(best) == {0, 50}
    big = (1 << 63) - 1
    assert sorted(best[50]) == [(1, 10, big), (2, 0, 512 * 256), (3, 0, 512 * 256), (4, None, 512 * 256), (5, 4, 0)]
    assert search.top_k(table.limit(0)).count() == 0


def test_pipeline_of_odd_documents(spark, docs, labels, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert 4 in ids(out)


BEFORE = """<html><head><title>t</title><style>p{}</style></head><body class="no-sidebar"><header><p>Top of all pages</p></header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>News and more</a></ul></nav><div class="cookie-notice"><p>We use cookies, agree</p></div>"""
AFTER = """<div class="comments"><h3>Comments</h3><p>First comment of a reader, a long one that says much about it all</p></div>
<form action=/s><p>Write to us</p><input name=q><button>Send</button></form><aside><p>Read more of this</p></aside>
<div id="sidebar"><p>Most read today</p></div><script>var x='<p>no</p>';</script><footer><p>All rights</p></footer></body></html>"""
WORDS = "One two, <b>three</b> &amp; four&nbsp;five <i>six</i>; "
TEXT = "One two, three & four five six;"
BODIES = {
    "article": (f"<article><h1>T</h1><p>{WORDS}<p>{WORDS}</p></article>", f"T {TEXT} {TEXT}"),
    "article with header and comments": (
        f"<article><header class=entry-header><h1>T</h1></header><div><p>{WORDS}</div><div>{WORDS}</div><div class='ad'>Buy</div>"
        f"<section id='reader-comments'><p>Me too</p></section></article>", f"T {TEXT} {TEXT}",
    ),
    "main": (f"<main class='with-sidebar'><h2>T</h2><ul><li>{WORDS}<li>b</ul><pre>c\n  d</pre></main>", f"T {TEXT} b c d"),
    "divs": (
        f"<div class=wrap><div class=content><h2>T</h2><p>{WORDS * 4}</p><p>{WORDS * 9}</p></div></div>",
        f"T {' '.join([TEXT] * 13)}",
    ),
    "line breaks": (f"<div>{'<br>'.join([WORDS * 3] * 6)}</div>", " ".join([TEXT] * 18)),
    "table": (
        f"<table><tr><td><a href=1>One</a><br><a href=2>Two</a><td><p>{WORDS * 5}<p>{WORDS * 5}</table>",
        " ".join([TEXT] * 10),
    ),
}


@pytest.mark.parametrize("name", BODIES)
def test_main_text(name):
    body, text = BODIES[name]
    assert html.extract(BEFORE + body + AFTER) == text


PARAGRAPHS = "".join(f"<p>{WORDS * 6}</p>" for _ in range(6))
LINKS = "".join(f"<li><a href=/{i}>Other page {i}</a></li>" for i in range(30))


@pytest.mark.parametrize(
    "beside",
    [
        "<div class=x><article><a href=/1>A teaser</a></article><article><a href=/2>Another teaser</a></article></div>",
        "<article class=comment><p>Me too, and more than that</p></article>",
        "<article hidden><p>Not shown to anybody at all</p></article>",
    ],
)
def test_density_decides_beside_articles(beside):
    """Main text in a div stays, and teasers or comments in articles do not take its place."""
    found = html.extract(f"<html><body><div class=text>{PARAGRAPHS}</div>{beside}</body></html>")
    assert found == " ".join([TEXT] * 36)


def test_density_decides_in_main():
    """A main that is mostly something else is not taken whole."""
    found = html.extract(f"<html><body><main><div>{PARAGRAPHS}</div><div><span>{'<i>a</i>bcdefgh ' * 300}</span></div></main></body></html>")
    assert TEXT in found and "bcdefgh" not in found


LONG = "<p>" + "One two, three &amp; four five six; " * 9 + "</p>"
LONG_TEXT = " ".join([TEXT] * 9)
WRAPPED = {
    "form around the page": '<form id="aspnetForm">{}<input name=q><label>Name</label><button>Send</button></form>',
    "layout by name": '<div class="sidebar-right">{}</div>',
    "article open for comments": '<article class="post comments-open">{}</article>',
    "free of adverts": '<div class="content ad-free">{}</div>',
    "a topic in an id": '<article id="privacy-law-ruling">{}</article>',
    "marks within marks": '<form><div class="sidebar-right"><div class="nav"><a href=/>Home</a></div><div class="content ad-free">{}</div></div></form>',
    "a wrapped article": '<div class="menu-page"><article>{}</article><div class="comments">' + LONG + "</div></div>",
    "a teaser beside": '<article class="post comments-open">{}</article><article><p>' + WORDS * 4 + "</p></article>",
}


@pytest.mark.parametrize("name", WRAPPED)
def test_marks_on_what_holds_the_page(name):
    """No mark takes away what holds most of the text outside links."""
    page = "<html><body><div class=top><a href=/>Home</a> Daily</div>" + WRAPPED[name].format(LONG + LONG) + "<footer>All rights</footer></body></html>"
    found = html.extract(page)
    assert found.startswith(f"{LONG_TEXT} {LONG_TEXT}") and "rights" not in found and "Send" not in found and "Name" not in found
    assert name == "a teaser beside" or found == f"{LONG_TEXT} {LONG_TEXT}"


def test_topic_of_a_paragraph():
    """A paragraph of an article may be called a discussion; a section of that name is one of readers."""
    found = html.extract(f'<article>{LONG}<p class="discussion">Both views are held</p><section class="discussion"><p>Me too</p></section></article>')
    assert found == f"{LONG_TEXT} Both views are held"


@pytest.mark.parametrize(
    "page",
    [
        '<div class="cookie-notice">' + LONG + LONG + "</div>",
        '<div class="banner">' + LONG + "</div>",
        '<div id="comments">' + LONG * 5 + "</div>",
        "<nav>" + LONG * 2 + "</nav>",
        "<form>" + LONG + "<input></form>",
    ],
)
def test_pages_of_nothing_but_marks(page):
    assert html.extract(f"<html><body><h1>T</h1>{page}</body></html>") in ("", "T")


def test_long_comments_beside_a_short_article():
    found = html.extract(f'<html><body><div class=text>{LONG}</div><div class="reader-responses">{LONG * 20}</div></body></html>')
    assert found == LONG_TEXT


def test_paragraph_of_lines():
    """Line breaks do not make one paragraph outweigh the text it is part of."""
    found = html.extract("<html><body><div><h1>A heading</h1><p><b>First line of text<br>second line of text</b></p><p>A short end</p></div></body></html>")
    assert found == "A heading First line of text second line of text A short end"


def test_many_marks_in_each_other():
    page = '<div class="sidebar">' * 20_000 + LONG + LONG
    assert html.extract(page) == f"{LONG_TEXT} {LONG_TEXT}"


def test_two_containers():
    """Both of two containers of paragraphs, though one has the greater sum; not the links between them."""
    first, second = PARAGRAPHS.replace("One", "First"), PARAGRAPHS + PARAGRAPHS
    found = html.extract(f"<html><body><div>{first}</div><ul>{LINKS}</ul><div>{second}</div></body></html>")
    assert found == " ".join([TEXT.replace("One", "First")] * 36 + [TEXT] * 72)


@pytest.mark.parametrize("page", ["<", "<p", "<!--", "<a href='", "&#xfffffff;", "</p></p>", "<script>", "<b>" * 50_000 + "x", "<td>x<li>y", "\x00<p>\ud7ff"])
def test_broken_pages(page):
    assert isinstance(html.extract(page), str)


def test_url_segments_and_support(spark):
    """Urls told apart by a third segment, by what follows a number, or by the scheme; and a rule of 0.9% of the labels."""
    made = [(f"http://a.org/x/y/{'good' if i % 2 else 'bad'}", "good/" if i % 2 else "bad/") for i in range(400)]
    made += [(f"http://a.org/n/{i + 100}.{'html' if i % 2 else 'exe'}", "html/" if i % 2 else "exe/") for i in range(400)]
    made += [("https://b.net/s", "https/") if i % 2 else ("ftp://b.net/s", "ftp/") for i in range(182)]
    made += [("http://c.com/rare", "rare/")] * 9
    labelled = spark.createDataFrame(
        [(u, "allow" if r in ("good/", "html/", "https/") else "block") for u, r in made], "url string, label string"
    )
    parts = labelled.select("url", "label", urls.host_of().alias("host"), urls.path_of().alias("path"))
    tokens = parts.select(urls.url_tokens().alias("tokens"), "label")
    asked = ["http://z.org/x/y/bad", "http://z.org/x/y/good", "http://z.org/n/1.exe", "http://z.org/n/1.html", "ftp://z.biz/", "http://c.com/rare"]
    tokens = tokens.coalesce(1).withColumn("row_id", F.monotonically_increasing_id())
    least = inspect.signature(urls.judge_urls).parameters["min_support"].default * tokens.count()
    sets = spark.createDataFrame([(u,) for u in asked], "url string").select("url", urls.host_of().alias("host"), urls.path_of().alias("path"))
    classes = urls.token_classes(tokens, least)
    out = urls.match_rules(sets.select(F.col("url").alias("set_id"), urls.url_tokens().alias("tokens")), urls.mine_rules(tokens, classes, least, 0.8), classes)
    assert {r["set_id"]: r["label"] for r in out.collect()} == dict(zip(asked, ["block", "allow", "block", "allow", "block", "block"]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules_by_enumeration(spark, seed):
    """Every combination of tokens, counted one by one: the same shares decide, and a url goes the way of the best of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        own = {t for t in "abcdef" if rng.random() < 0.4} | {"all", "every"}
        own |= {"k1", "k2"} if rng.random() < 0.3 else set()
        bad = "a" in own and "b" not in own or "k1" in own and rng.random() < 0.9
        rows.append((i, sorted(own), "block" if bad else "allow"))
    asked = [(str(i), sorted({t for t in [*"abcdef", "all", "k1", "k2", "new"] if rng.random() < 0.4})) for i in range(80)]
    least, counted = 12, Counter()
    for _, own, label in rows:
        for n in range(1, 5):
            for some in combinations(own, n):
                counted[some] += 1
                counted[some, label] += 1
    best = {}
    for some in [k for k in counted if not isinstance(k[0], tuple)]:
        for label in ("allow", "block"):
            if counted[some, label] >= least and counted[some, label] / counted[some] >= 0.8:
                best[some] = (counted[some, label] / counted[some], counted[some, label], label)
    labelled = spark.createDataFrame(rows, "row_id long, tokens array<string>, label string")
    classes = urls.token_classes(labelled, least)
    mined = urls.mine_rules(labelled, classes, least, 0.8)
    members = {}
    for r in classes.collect():
        members.setdefault(r["item"], []).append(r["token"])
    assert sorted(map(sorted, members.values())) == [*[[t] for t in "a"], ["all", "every"], *[[t] for t in "bcdef"], ["k1", "k2"]]
    got = {tuple(r["items"]): (r["confidence"], round(r["support"] * 300), r["label"]) for r in mined.collect() if 0 < len(r["items"]) < 5}
    short = {k: v for k, v in best.items() if not {"all", "every", "k2"} & set(k)}
    assert {k: v for k, v in got.items() if len(k) < 5} == {k: (pytest.approx(v[0]), *v[1:]) for k, v in short.items()}
    out = {r["set_id"]: r["label"] for r in urls.match_rules(spark.createDataFrame(asked, "set_id string, tokens array<string>"), mined, classes).collect()}
    every = {tuple(r["items"]): (r["confidence"], r["support"] * 300, r["label"]) for r in mined.collect()}
    for name, own in asked:
        items = {i for i, m in members.items() if set(m) & set(own)}
        fits = [(v[0], v[1], len(k), v[2]) for k, v in every.items() if (set(k) <= items if k else "all" in own or "every" in own)]
        if not fits:
            assert name not in out
            continue
        top = max(f[:3] for f in fits)
        assert out[name] in {f[3] for f in fits if f[:3] == pytest.approx(top)}
