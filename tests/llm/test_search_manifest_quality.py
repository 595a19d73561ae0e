"""Lexical search, Merkle manifest and quality rules: brute force, held-out labels, edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.llm import lexical, merkle, quality

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, tree string, pos string, n string, rank string, key string, measures string"
DOCS = [
    (1, "One line of five words\nand another line of words", "en", "b"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (None, "one  LINE of five words\nshort", "en", None),
    (4, "a very long text " * 40_000, "de", "a"),
    (5, "repeated row with some words", "en", "b"),
    (5, "repeated row with some words", "en", "b"),
    (5, "the same id and another text", "en", None),
    (None, None, None, None),
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *"abcdefg") for i, t, g, s in rows], DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, DOCS).limit(0)


# lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def best_documents(docs, items, k=10):
    """Every document against every item; docs as (doc_id, text), items as (item_id, text)."""
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted]
    n_docs, length = sum(1 for x in counted if x[2]), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in set(TERM.findall(lowered(text)))}
        scores = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // max(1, length)
            score = sum(x * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, x in w.items())
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in lexical.terms(text.encode())] == TERM.findall(lowered(text))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(9000)]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 200]))) for _ in range(700)]
    texts += [texts[7]] * 40 + [None, "", "W3 w3,w3-é É"]
    return list(enumerate(texts)), [(i, " ".join(rng.choices(words, k=12))) for i in range(30)] + [(30, None), (31, "É w3"), (31, "É w3"), (32, "nowhere")]


@pytest.mark.parametrize("block_terms, chunk_docs", [(1 << 14, 8192), (40, 64)])
def test_search_matches_brute_force(spark, corpus, block_terms, chunk_docs):
    docs, items = corpus
    got = lexical.ranked(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"),
        block_terms=block_terms, chunk_docs=chunk_docs,
    )
    assert found(got) == best_documents(docs, items)


def test_search_prunes(corpus):
    """Far fewer pairs of documents and items are scored than there are, and none that belongs to the best."""
    rng = np.random.default_rng(1)
    n, v = 4000, 300
    weights = np.sort(rng.integers(1, 9000, v))[::-1].copy()
    own = [np.unique(rng.zipf(1.3, 20) % v) for _ in range(n)]
    values = [rng.integers(1000, 90_000, len(o)) for o in own]
    for i in range(0, n, 40):
        values[i] = values[i] * 9
    items = lexical.Items(list(range(50)), [np.unique(rng.integers(0, v, 15)) for _ in range(50)], weights)
    chunk = lexical.Chunk.of(list(range(n)), np.array([len(o) for o in own]), np.concatenate(own), np.concatenate(values), weights)
    search = lexical.Search(items, chunk, 10, np.zeros(50, np.int64))
    search.seeds()
    again = lexical.Search(items, chunk, 10, search.kth.copy())
    best = again.run()
    for i, terms in enumerate(items.terms):
        scores = sorted((-int(weights[o[m]] @ x[m]), d) for d, (o, x) in enumerate(zip(own, values)) if (m := np.isin(o, terms)).any())
        assert [(-s, chunk.ids[j]) for s, j in best[i]] == scores[:10]
    assert again.scored < 0.5 * n * 50


def test_search_edges(spark, docs, none):
    items = spark.createDataFrame([(1, "five words"), (1, "five words"), (2, None), (None, "repeated"), (3, "text " * 5000)], "item_id long, text string")
    items = items.withColumn("doc_id", F.lit("x")).withColumn("rank", F.lit("y"))
    assert found(lexical.ranked(docs, items)) == best_documents([d[:2] for d in DOCS], [(1, "five words")] * 2 + [(None, "repeated"), (3, "text")])
    assert lexical.ranked(none, items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
    assert lexical.ranked(none, items).dtypes == lexical.ranked(docs, items).dtypes


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def manifest(rows):
    """Rows as (doc_id, source, lang, n_chars, text): what each one's result is, by whole trees rebuilt for each version."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))

    def trees(changed=None):
        own = [levels_of([leaf(changed[1]) if changed and r is changed[0] else leaf(r) for r in groups[g]]) for g in names]
        return own, levels_of([t[-1][0] for t in own])

    own, top = trees()
    out = []
    for gi, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            beside = []
            for levels, j in ((own[gi], i), (top, gi)):
                for nodes in levels[:-1]:
                    first = j - j % 8
                    beside += [n for k, n in enumerate(nodes[first : first + 8], first) if k != j]
                    j //= 8
            root = top[-1][0]
            version = root
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                version = trees((r, (*r[:4], None if r[4] is None else lowered(r[4]))))[1][-1][0]
            out.append((r[0], leaf(r), own[gi][-1][0], root, sha(*beside), version, version == root))
    return Counter(out)


def as_rows(docs):
    return [(i, s, g, len(t or ""), t) for i, t, g, s in docs]


def reported(df):
    return Counter(tuple(r) for r in merkle.manifest_report(df).collect())


@pytest.mark.parametrize("n", [1, 7, 8, 9, 64, 65, 700])
def test_manifest_matches_rebuilt_trees(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["Text A", "text b", "", None, "ÄÖ É"]), rng.choice(["en"] * 9 + ["de", None]), "s") for i in rng.sample(range(5000), n)]
    if n == 700:  # more leaves than a block has, and more trees than a node has children
        rows = [(i, t, "en" if k < 600 else f"l{k % 11}", s) for k, (i, t, _, s) in enumerate(rows)]
    assert reported(table(spark, rows)) == manifest(as_rows(rows))


def test_versions_share_untouched_nodes(spark):
    rows = [(i, f"Text {i}", "en", "s") for i in range(600)]
    built = merkle.build(table(spark, rows), changed=F.col("doc_id") == 77, altered={"text": F.lit("other")})
    got = {r["key"]: r for r in merkle.versions(built).collect()}
    first, second = (levels_of([leaf((i, "s", "en", len(t), "other" if i == c else t)) for i, t, _, _ in rows]) for c in (None, 77))
    assert got[77]["copied"] == [nodes[77 // 8**k] for k, nodes in enumerate(second)]
    assert [sum(a != b for a, b in zip(x, y)) for x, y in zip(first, second)] == [1, 1, 1, 1, 1]
    assert all(r["copied"][-1] == r["root"] for k, r in got.items() if k != 77)
    assert sum(r["changed"] for r in got.values()) == 1


def test_manifest_edges(docs, none):
    assert reported(docs) == manifest(as_rows(DOCS))
    assert merkle.manifest_report(none).count() == 0


# quality rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    twice = {w for w, c in Counter(windows).items() if c > 1}
    inside = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


@given(st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\x1c", "\x85", "é#", "$|", "\t", "c d c d", "\r\n", "𝔘"]), max_size=60).map("".join))
@settings(max_examples=400, deadline=None)
def test_counts(text):
    data = text.encode()
    assert quality.counts(data, quality.Words.of(data)) == plain_counts(text)


def plain_buckets(text):
    """Each family's buckets by a loop over words and their grams."""
    words = quality.Words.of(text.encode())
    grams = [g for w in WORD.findall(text) for n in (2, 3, 4) for i in range(len(w) + 3 - n) for g in [f" {w} "[i : i + n]]]
    return len(grams), sum(len(g) for g in words.grams())


@pytest.mark.parametrize("piece", [1 << 18, 7])
def test_grams(monkeypatch, piece):
    monkeypatch.setattr(quality, "_PIECE", piece)
    for text in ("one two", "a", "é 𝔘x\nlonger words here  and there", "", " \t"):
        expected, got = plain_buckets(text)
        assert got == expected
    whole = Counter(np.concatenate(list(quality.Words.of(b"word other word").grams())).tolist())
    apart = sum((Counter(np.concatenate(list(quality.Words.of(w).grams())).tolist()) for w in (b"word", b"other", b"word")), Counter())
    assert whole == apart


def test_logit_is_the_product_of_features_and_weights():
    weights = np.random.default_rng(0).normal(size=quality.FAMILIES << 16)
    for text in ("one", "one two two, ONE!", "é " * 50 + "x y", ""):
        words = quality.Words.of(text.encode())
        buckets, values = words.features()
        assert words.logit(weights) == pytest.approx(float(weights[buckets] @ values), rel=1e-5, abs=1e-6)


def test_calibration_gives_shares():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=20_000) * 3
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 * logits - 1)))).astype(int)
    slope, offset = quality.calibrate(logits, y, np.ones(len(y)))
    assert slope == pytest.approx(0.5, abs=0.05) and offset == pytest.approx(-1, abs=0.1)


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality_report(docs, labels).join(labels, "doc_id").where(quality.held_out()).toPandas()
    assert judged[judged.quality == 0].kept.mean() < 0.02
    assert judged[(judged.quality == 1) & ~judged.base_failed].kept.mean() > 0.98
    sure = judged[judged.probability > 0.9]
    assert sure.quality.mean() == pytest.approx(sure.probability.mean(), abs=0.03)


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (2, None, None), (4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_report(docs, labels)
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(d[0] for d in DOCS)
    by_text = {(r["n_words"], r["n_repeat_words"], r["base_failed"]) for r in got.where("doc_id = 4").collect()}
    assert by_text == {(160_000, 160_000, True)}
    assert not any(r["kept"] for r in got.where("base_failed").collect())
    assert quality.quality_report(none, labels).count() == 0
    assert {r["probability"] > 0.99 for r in quality.quality_report(docs, labels.limit(0)).collect()} == {True}
    assert quality.of_quality(docs, labels, min_words=0, max_repeated=100, min_probability=0.0).columns == docs.columns
    assert quality.of_quality(docs, labels, min_words=0, max_repeated=100, min_probability=0.0).count() == len(DOCS)
