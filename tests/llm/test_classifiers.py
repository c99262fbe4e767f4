import random

import numpy as np
import pytest

from tessera.llm import html_text as H, language as L, quality as Q, toxicity as X
from tests.llm.conftest import ODD


def prose(rng, stem, n):
    return " ".join(f"{stem}{rng.choice('abcdefgh')}{rng.choice('mnop')}".capitalize() + rng.choice(["", "", ",", "."]) for _ in range(n))


def test_positive_unlabelled_quality(spark, make):
    rng = random.Random(1)
    good = [(i, prose(rng, "wo", rng.randint(20, 120))) for i in range(600)]
    bad = [(i, " ".join(w + "***" for w in prose(rng, "wo", 60).split())) for i in range(600, 700)]
    docs, train, labels = Q.training_fold(make(good + bad + ODD), spark.createDataFrame([(i, 1) for i in range(250)], "doc_id long, quality int"))
    model = Q.fit(train, labels)
    s = {r.doc_id: r.score for r in Q.scored(docs, model).collect()}
    assert np.mean([s[i] >= 0.3 for i, _ in good]) > 0.97 and np.mean([s[i] < 0.3 for i, _ in bad]) > 0.9
    assert 0.5 < model[1] < 0.95
    assert len(Q.scored(docs, None).collect()) == 700 + len(ODD)
    none = Q.fit(train, labels.limit(0))
    assert none is None


def test_viterbi_is_optimal():
    rng = np.random.default_rng(4)
    for _ in range(200):
        s = rng.normal(0, 3, (rng.integers(1, 6), 3))
        best = max((sum(s[t, p[t]] for t in range(len(s))) - 2.0 * sum(a != b for a, b in zip(p, p[1:])), p) for p in np.ndindex(*(3,) * len(s)))[0]
        path = L.viterbi(s, 2.0)
        assert sum(s[t, path[t]] for t in range(len(s))) - 2.0 * sum(a != b for a, b in zip(path, path[1:])) == pytest.approx(best)


def test_languages_and_spans(spark, make):
    from pyspark.sql import functions as F

    rng = random.Random(2)
    rows = [(i, prose(rng, "the" if i % 2 else "sch", 40), "en" if i % 2 else "de") for i in range(200)] + [(1000, prose(rng, "при", 30), "ru"), (1001, prose(rng, "при", 30), "ru"), (1002, None, None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(train)
    mixed = prose(rng, "the", 25) + " " + prose(rng, "sch", 15)
    docs = make([(1, mixed), (2, prose(rng, "при", 9)), (3, "123 ..."), *ODD]).withColumn("held_out", F.lit(False))
    got = {r.doc_id: r for r in L.identified(docs.filter("doc_id < 4 and (text is null or length(text) <> 1)"), model).collect() if r.spans or r.lang_pred == "und"}
    assert got[1].lang_pred in ("en", "und")
    spans = next(r for r in L.identified(docs, model).collect() if r.doc_id == 1 and r.spans).spans
    assert [s.lang for s in spans] == ["en", "de"] and abs(spans[0].n_words - 25) <= 1
    assert next(r for r in L.identified(docs, model).collect() if r.doc_id == 2 and r.spans).lang_pred == "ru"
    assert {r.lang_pred for r in L.identified(docs, None).collect()} == {"und"}
    assert L.fit(train.limit(0)) is None


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(5)
    for sizes in ([3], [1, 0, 5], [4, 2]):
        sizes = np.array(sizes)
        emission, start, move = rng.normal(0, 2, sizes.sum()), rng.normal(0, 1, 2), rng.normal(0, 1, (2, 2))
        got = X.marginals(X.Layout(sizes), emission, start, move)[0]
        at = 0
        for n in sizes:
            total, ones = 0.0, np.zeros(n)
            for path in np.ndindex(*(2,) * n):
                w = np.exp(sum(emission[at + t] * path[t] for t in range(n)) + (start[path[0]] if n else 0) + sum(move[a, b] for a, b in zip(path, path[1:])))
                total += w
                ones += w * np.array(path)
            assert got[at : at + n] == pytest.approx(ones / total)
            at += n


def test_chain_marginals_across_chunks():
    rng = np.random.default_rng(6)
    n = 3 * X.CHUNK + 17
    emission, start, move = rng.normal(0, 2, n), rng.normal(0, 1, 2), rng.normal(0, 1, (2, 2))
    got = X.marginals(X.Layout(np.array([n])), emission, start, move)[0]
    f, b = np.zeros((n, 2)), np.ones((n, 2))
    e = np.stack([np.ones(n), np.exp(emission)], 1)
    f[0] = np.exp(start) * e[0]
    for t in range(1, n):
        f[t] = (f[t - 1] @ np.exp(move)) * e[t]
        f[t] /= f[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = np.exp(move) @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    p = f * b
    assert got == pytest.approx(p[:, 1] / p.sum(1))


def test_toxic_spans(spark, make):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = prose(rng, "wo", 40).split()
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["Vilezza", "Vilezzo!", "grubbit"])
        rows.append((i, " ".join(words)))
    rows += [(500, prose(rng, "wo", 20) + " vilezzissimo!"), (501, prose(rng, "wo", 20))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    docs, train, labels = Q.training_fold(make(rows + [(900 if i is None else i + 1000, t) for i, t in ODD]), labels, 4, 2)
    chain = X.fit(train, labels)
    out = {r.doc_id: r for r in X.tagged(docs, chain).collect()}
    assert all((out[i].score >= 0.3) == (i % 4 == 0) for i in range(400))
    assert out[500].score > out[501].score and out[1001].score < 0.3
    text = rows[0][1]
    s = out[0].spans[0]
    assert text[s.start : s.stop].strip("!") in ("Vilezza", "Vilezzo", "grubbit")
    assert X.fit(train, labels.limit(0)) is None and {r.score for r in X.tagged(docs, None).collect()} == {0.0}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><a href=x>Site</a></header><nav><ul><li><a href=a>One</a></li></ul></nav>
<!-- note --><div class="ad">Buy the thing of the day that is for you</div><aside>Side <p>text of the side</p></aside><article><h1>A &amp; B</h1><p><b>First  the
line<br>goes &#39;on&#x27;<p>Short.</p><p>Only <a href=q>one link</a> here</p><form><input><label>Name</label></form><div class="comments"><p>I like the article and the site</p></div></article><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert H.main_text(PAGE) == "A & B\n\nFirst the line goes 'on'\n\nShort.\n\nOnly one link here"
    assert H.main_text(None) == "" and H.main_text("") == ""
    for cut in range(0, len(PAGE), 11):
        H.main_text(PAGE[:cut])
    assert H.main_text(PAGE[: PAGE.index("Short.") + 4]).endswith("\n\nShor")


def test_rules_without_an_article():
    long = "The story of the house is that it was in the town and that it had the door of the old one. " * 4
    page = f"<body><div><a href=x>Menu one</a> <a href=y>Menu two</a></div><div>{long}</div><div>Brief note.</div><div>{long}</div><div><a href=z>Next</a></div></body>"
    assert H.main_text(page) == "\n\n".join([long.strip(), "Brief note.", long.strip()])


def test_pages(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "<p>" * 3000 + "deep", "x")], "page_id long, url string, html string, text string")
    rows = H.extract(df).collect()
    assert len(rows) == 4 and rows[0].text == rows[1].text and all(r.n_chars == len(r.text) for r in rows)
    assert H.extract(df.limit(0)).count() == 0
