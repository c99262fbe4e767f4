import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking as B, evaluation as E, matching as M, profiling as P, resolution as R, training as T
from tessera.operators.blocking import ANCHOR, CANDIDATE

RECORD = "entity_id string, business_name string, business_address string, country string"
CANDIDATES = [
    ("S2-1", "Blaue Mühle Bäckerei GmbH", "Am Markt 7, Weimar, 99423", "DE"), ("S3-1", "BLAUE MÜHLE BÄCKEREI", "Am Markt 7 , Weimar, 99423", "de"), ("S3-2", "Bäckerei Blaue Mühle", "Markt, Weimar", "DE"),
    ("S2-2", "Harbour Lights Chandlery Co.", "41 Quay Road, Falmouth, 55210", "UK"), ("S2-3", "Harbor Light Chandlers", "41 Quay Rd, Falmouth, 55210", "UK"), ("S3-3", "Nordlys Optikk", "12 Storgata, Tromso, 90081", "NO"), ("S2-4", None, None, None), ("S3-4", "", "", "UK"),
]
ANCHORS = [("S1-1", " blaue  mühle bäckerei ", "Am Markt 7, Weimar, 99423", "DE"), ("S1-2", "Harbour Lights Chandlery Ltd", "41 Quay Road, Falmouth, 55210", "UK"), ("S1-3", "Zig Zag Kites", "3 Hill Lane, York, 77110", "UK"), ("S1-4", None, None, None)]


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(ANCHORS, RECORD), spark.createDataFrame(CANDIDATES, RECORD)


def found(pairs, *columns):
    return {tuple(r[c] for c in columns) for r in pairs.collect()}


def test_exact_keys(sides):
    a, c = sides
    got = found(B.key_join(B.exact_keys(a), B.exact_keys(c)), ANCHOR, CANDIDATE, "strategy")
    assert ("S1-1", "S3-1", "exact_name") in got and ("S1-2", "S2-2", "exact_country_postal_house") in got
    assert not {x for x in got if x[0] == "S1-4" or x[1] in ("S2-4", "S3-4")}


def test_tokens_addresses_and_grams(sides):
    a, c = sides
    names = found(B.top_by_hits(B.key_join(B.name_token_keys(a), B.name_token_keys(c)), 50), ANCHOR, CANDIDATE)
    assert {("S1-1", x) for x in ("S2-1", "S3-1", "S3-2")} <= names
    assert ("S1-2", "S2-3") in found(B.key_join(B.address_keys(a), B.address_keys(c)), ANCHOR, CANDIDATE)
    assert ("S1-2", "S2-2") in found(B.ngram_join(a, c), ANCHOR, CANDIDATE)
    assert {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-1", "S3-2")} <= found(B.tfidf_join(a, c, "business_name", 5, "tfidf_name", 0.10), ANCHOR, CANDIDATE)


def cosines(anchors, candidates, k, least):
    """TF-IDF top-k per source by comparing all texts."""
    import math
    import re
    from collections import Counter

    def terms(t):
        w = re.findall(r"\w+", t.lower())
        return Counter(w + [f"{x} {y}" for x, y in zip(w, w[1:])])

    docs = {i: terms(t) for i, t in candidates}
    df = Counter(t for d in docs.values() for t in d)
    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + f)) + 1 for t, f in df.items() if n < 10 or 2 <= f <= 0.85 * n}

    def vector(c):
        v = {t: (1 + math.log(f)) * idf[t] for t, f in c.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    vectors = {i: vector(c) for i, c in docs.items()}
    out = set()
    for a, t in anchors:
        q = vector(terms(t))
        scores = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 9), i) for i, v in vectors.items()]
        for source in ("S2", "S3"):
            best = sorted((-s, i) for s, i in scores if s >= least and i.startswith(source))[:k]
            out |= {(a, i, round(-s, 6)) for s, i in best}
    return out


@pytest.mark.parametrize("k", [1, 3, 50])
def test_tfidf_join_against_all_pairs(spark, k):
    rng = random.Random(k)
    words = ["the", "the", "the", "of"] + [f"w{i}" for i in range(25)] + ["é", "x"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(1, 6)))
    some = [text() for _ in range(30)]
    anchors, candidates = [(f"S1-{i}", rng.choice(some)) for i in range(25)], [(f"S{2 + i % 2}-{i}", rng.choice([*some, text()])) for i in range(90)]
    frame = lambda rows: spark.createDataFrame([(i, t, None, "X") for i, t in rows], RECORD)
    got = B.tfidf_join(frame(anchors), frame(candidates), "business_name", k, "tfidf_name")
    assert {(r[ANCHOR], r[CANDIDATE], round(r.score, 6)) for r in got.collect()} == cosines(anchors, candidates, k, 0.15)


def grams(anchors, candidates, k=3):
    """The gram join's rule by comparing all names."""
    import re

    def of(t):
        name = " ".join(re.findall("[a-z0-9]+", t.lower()))
        s = f"_{name}_"
        return {s[i : i + 3] for i in range(len(s) - 2)} if len(name) >= 3 else set()

    out = set()
    for a, t in anchors:
        g = of(t)
        near = sorted((-len(g & of(u)), c, len(g & of(u)) / len(g | of(u))) for c, u in candidates if g & of(u))[: 2 * k]
        out |= {(a, c) for n, c, j in [x for x in near if x[2] >= 0.35 or -x[0] >= 5 and x[2] >= 0.25][:k]}
    return out


def test_gram_join_against_all_pairs(spark):
    rng = random.Random(8)
    words = ["mill", "milla", "river", "rive", "oak", "oaken", "stone", "a"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(1, 3)))
    anchors, candidates = [(f"S1-{i}", text()) for i in range(20)], [(f"S{2 + i % 2}-{i}", text()) for i in range(120)]
    frame = lambda rows: spark.createDataFrame([(i, t, None, "X") for i, t in rows], RECORD)
    assert found(B.ngram_join(frame(anchors), frame(candidates), k=3), ANCHOR, CANDIDATE) == grams(anchors, candidates)


def test_bounds_and_union(spark, sides):
    a, c = sides
    keys = B.name_token_keys(c)
    assert B.bounded(keys, 1).groupBy("country", "key").count().filter("count > 1").isEmpty()
    rows = [("S1-1", "S2-1", "exact_name"), ("S1-1", "S2-1", "tfidf_name"), ("S1-1", "S1-5", "exact_name"), ("S1-1", "odd", "exact_name"), ("S1-1", "S3-1", "tfidf_name")]
    u = B.union_pairs(spark.createDataFrame(rows, f"{ANCHOR} string, {CANDIDATE} string, strategy string"))
    assert found(u, CANDIDATE, "strategy_count", "strategies") == {("S2-1", 2, "exact_name;tfidf_name"), ("S3-1", 1, "tfidf_name")}
    assert found(B.known_only(u, c.filter("entity_id = 'S3-1'")), CANDIDATE) == {("S3-1",)}
    assert B.roster(a, u).count() == len(ANCHORS)


def test_recall(spark, sides):
    a, c = sides
    pairs = B.union_pairs(B.key_join(B.name_token_keys(a), B.name_token_keys(c)), B.key_join(B.address_keys(a), B.address_keys(c)), B.ngram_join(a, c))
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2"), ("S1-2", "S3-3")], f"{ANCHOR} string, {CANDIDATE} string")
    r = B.recall_report(a, pairs, truth).first()
    assert r.true_pairs == 4 and r.recall == 0.75 and r.recall_s2 == 1.0 and r.full_coverage == 0.5
    assert found(B.missed_pairs(pairs, truth), ANCHOR, CANDIDATE) == {("S1-2", "S3-3")}
    assert B.recall_report(a, pairs, truth.limit(0)).first().recall == 1.0


def test_baseline_and_features(sides):
    a, c = sides
    pairs = B.union_pairs(B.key_join(B.name_token_keys(a), B.name_token_keys(c)))
    ranked = M.rank_pairs(M.score_pairs(M.with_records(pairs, M.profile(a), M.profile(c))))
    rows = {(r[ANCHOR], r[CANDIDATE]): r for r in ranked.collect()}
    same = rows["S1-1", "S3-1"]  # equal but for case and space
    assert same.baseline_rank == 1 and same.name_similarity_score == pytest.approx(1.0)
    assert rows["S1-2", "S2-2"].a_core == "harbour lights chandlery" == rows["S1-2", "S2-2"].c_core
    f = M.featurize(ranked)
    assert len(f.columns) == 3 + M.FEATURE_COUNT == 3 + len(M.feature_registry())
    by = {(r[ANCHOR], r[CANDIDATE]): r for r in f.collect()}["S1-2", "S2-2"]
    assert (by.name_exact_match, by.name_core_exact_match) == (0.0, 1.0)
    T.check_features(f, [x["name"] for x in M.feature_registry()])
    with pytest.raises(ValueError):
        T.check_features(f, [ANCHOR])


# (anchor, candidate, probability, true)
SCORED = [
    ("S1-a", "S2-a", 0.97, 1), ("S1-a", "S3-a", 0.955, 1), ("S1-a", "S2-b", 0.11, 0), ("S1-b", "S2-c", 0.31, 0), ("S1-b", "S3-b", 0.08, 0), ("S1-c", "S3-c", 0.99, 1), ("S1-c", "S2-d", 0.91, 1), ("S1-d", "S2-e", 0.72, 0), ("S1-e", "S3-d", 0.98, 0),
]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame([(a, c, c[:2], p, y) for a, c, p, y in SCORED], f"{ANCHOR} string, {CANDIDATE} string, candidate_source string, prob double, label int").cache()


def test_entities(scored):
    e = {r[ANCHOR]: r for r in E.entities(scored, 0.95, 0.05).collect()}
    assert [e[f"S1-{i}"].status for i in "abcde"] == ["confident", "unmatched", "ambiguous", "ambiguous", "confident"]
    full = {r[ANCHOR]: r for r in E.entity_records(scored, 0.95, 0.05).collect()}
    assert len(full["S1-a"]) == 21 and all(full[i].prediction_status == e[i].status for i in e)
    assert full["S1-a"].predicted_candidate_ids == "S2-a,S3-a" and full["S1-c"].ground_truth_candidate_ids == "S3-c,S2-d"
    assert full["S1-c"].entity_has_false_negative and not full["S1-c"].entity_has_false_positive and full["S1-d"].second_candidate_id == ""
    assert e["S1-a"].gap == pytest.approx(0.015)
    s = {r.threshold: r for r in E.sweep(scored, [0.95]).collect()}[0.95]
    assert (s.tp, s.fp, s.fn) == (3, 1, 1) and s.precision == s.recall == 0.75


@pytest.mark.parametrize("n", [1, 2, 7, 400])
def test_quantiles(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    values = rng.choice([0.5, 1.0, rng.random(), -3.0, 1e6], n) + rng.integers(0, 3, n)
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)] + [(None, 0)], "v double, g int")
    got = E.quantiles(df, "v", {"a": 0.0, "b": 0.37, "c": 0.995}).first()
    assert tuple(got) == pytest.approx(tuple(np.quantile(values, [0, 0.37, 0.995])))
    groups = {r.g: r.b for r in E.quantiles(df, "v", {"b": 0.37}, "g").collect()}
    assert groups == pytest.approx({g: np.quantile(values[g::2], 0.37) for g in (0, 1) if len(values[g::2])})


def test_fan_in(spark):
    p = spark.createDataFrame([("S1-1", "S2-C", "S2", 0.98, 1), ("S1-2", "S2-C", "S2", 0.96, 0)], f"{ANCHOR} string, {CANDIDATE} string, candidate_source string, prob double, label int")
    assert E.fan_in(p, 0.95).count() == 1
    assert {r.status for r in E.entities(p, 0.95).collect()} == {"conflicting"}


def test_metrics(spark):
    y, p = [0, 1, 1, 0, 1, 0, 0, 0], [0.95, 0.9, 0.65, 0.55, 0.45, 0.35, 0.15, 0.02]
    df = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", "S2", b, a) for i, (a, b) in enumerate(zip(y, p))], f"{ANCHOR} string, {CANDIDATE} string, candidate_source string, prob double, label int")
    s = E.sweep(df, [0.5]).first()
    assert (s.tp, s.fp, s.fn, s.tn) == (2, 2, 1, 3)
    assert E.average_precision(df).first()[0] == pytest.approx((1 / 2 + 2 / 3 + 3 / 5) / 3)
    right = sum((a > b) + (a == b) / 2 for a, i in zip(p, y) if i for b, j in zip(p, y) if not j)
    assert E.roc_auc(df).first()[0] == pytest.approx(right / 15)
    x = spark.createDataFrame([(0.8, 0.4), (0.0, 0.0)], "p double, r double").select(E.f_beta(F.col("p"), F.col("r")).alias("f")).collect()
    assert x[0].f == pytest.approx(2 / 3) and x[1].f == 0


def test_macro_singletons(scored):
    g = {r.threshold: r for r in E.macro_grid(scored, [0.5, 0.95]).collect()}
    assert g[0.95].singleton_fp == 1 and g[0.95].exact_sets == 3
    assert g[0.5].singleton_fp == 2 and g[0.5].exact_sets == 3
    fine = E.coarse_then_fine(scored).count()
    assert fine > 101 and E.pick_macro(E.coarse_then_fine(scored)).first().threshold == pytest.approx(0.91, abs=1e-6)


def test_resolution_and_validation(spark, scored):
    lists = R.id_lists(scored, R.resolve(scored, 0.95))
    got = {r[ANCHOR]: r.matched_entity_ids for r in lists.collect()}
    assert got["S1-a"] == "S2-a,S3-a" and got["S1-b"] == ""
    known = scored.select(F.col(CANDIDATE).alias("entity_id"))
    assert {r.status for r in R.validate_lists(lists, "matched_entity_ids", scored, known).collect()} == {"PASS"}
    bad = spark.createDataFrame([("S1-a", "S2-a,S2-a,S1-a,X-1"), ("S1-a", ""), ("S1-z", "")], f"{ANCHOR} string, matched_entity_ids string")
    v = {r.rule: r.violations for r in R.validate_lists(bad, "matched_entity_ids", scored, known).collect()}
    assert v == {"duplicate_anchor": 1, "missing_anchor": 4, "extra_anchor": 1, "duplicate_in_list": 1, "self_match": 1, "bad_prefix": 2, "unknown_id": 2}


def test_mining_and_split(scored):
    m = scored.withColumns({"baseline_score": F.lit(0.7), "name_core_exact_match": F.lit(0), "name_token_jaccard": F.lit(0.1), "postal_exact_match": F.lit(1), "address_exact_match": F.lit(0)})
    mined = {r[CANDIDATE]: r for r in T.mine_hard_negatives(m).collect()}
    assert "high_model_probability_ge_0.50" in mined["S3-d"].hard_negative_reason and mined["S3-d"].primary_category == "high_confidence_model_false_positive"
    assert [r[CANDIDATE] for r in T.in_order(T.mine_hard_negatives(m)).collect()][:2] == ["S3-d", "S2-e"]
    s = T.split_entities(scored, 0.4)
    assert s.groupBy(ANCHOR).agg(F.countDistinct("is_val").alias("n")).filter("n > 1").isEmpty()


def test_truth_analysis(spark):
    t = spark.createDataFrame([("S1-a", "S3-5,S2-4,S2-6"), ("S1-b", None), ("S1-c", "S3-9")], f"{ANCHOR} string, matched_entity_ids string")
    r = P.truth_analysis(t).first()
    assert (r.rows, r.singletons, r.one_match, r.many_matches, r.from_s2, r.from_s3, r.most, r.unsorted_lists) == (3, 1, 1, 1, 2, 2, 3, 1)
    assert found(P.linked_sample(t, 5), ANCHOR, CANDIDATE) == {("S1-a", "S3-5"), ("S1-a", "S2-4"), ("S1-c", "S3-9")}


def test_scripts(spark):
    df = spark.createDataFrame([("abc",), ("café",), ("Привет",), ("日本ご",), (None,)], "t string")
    assert found(P.script_profile(df, "t"), "script", "n") == {("ascii_or_common", 1), ("latin_extended", 1), ("cyrillic", 1), ("kana+cjk", 1)}
