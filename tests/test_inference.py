"""Settings, artefacts, models, the batch pipeline, result files and their validation."""

import random

import pytest
from pyspark.sql import functions as F

from tessera import settings
from tessera.operators import blocking as B, inference as I, matching as M, models, resolution as R, submission as S, training as T
from tessera.operators.blocking import ANCHOR, CANDIDATE
from tessera.sources import artefacts, files

RECORD = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def world(spark):
    """Firms of which each source holds a spelling, and their true pairs."""
    rng = random.Random(4)
    words = "amber birch cedar delta ember fjord grove heron iris jasper kelp larch maple north opal pine quartz river stone tide".split()
    rows, truth = {1: [], 2: [], 3: []}, []
    for i in range(120):
        name, street = " ".join(rng.sample(words, 3)), f"{rng.randrange(1, 99)} {rng.choice(words)} road, {10000 + i}"
        rows[1].append((f"S1-{i}", name.title(), street, "UK"))
        for s in (2, 3):
            if rng.random() < 0.8:
                other = name.upper() + " Ltd" if rng.random() < 0.5 else name
                rows[s].append((f"S{s}-{i}", other, street if rng.random() < 0.7 else None, "uk"))
                truth.append((f"S1-{i}", f"S{s}-{i}"))
    frames = {s: spark.createDataFrame(r, RECORD).cache() for s, r in rows.items()}
    return frames, spark.createDataFrame(truth, f"{ANCHOR} string, {CANDIDATE} string").withColumn("label", F.lit(1)).cache()


@pytest.fixture(scope="module")
def model_path(spark, world, tmp_path_factory):
    frames, truth = world
    both = I.both_sources(frames[2], frames[3])
    pairs = I.candidates_of(frames[1], both, settings.from_mapping({}).blocking)
    held = M.with_records(pairs, M.profile(frames[1]), M.profile(both)).join(truth, [ANCHOR, CANDIDATE], "left").fillna(0, ["label"])
    data = M.featurize(M.rank_pairs(M.score_pairs(held)), "label")
    columns = [x["name"] for x in M.feature_registry()]
    path = f"{tmp_path_factory.mktemp('model')}/m"
    models.save(T.fit_boosted(data, columns, rounds=6, depth=3), path, columns, threshold=0.5)
    return path


def test_settings():
    s = settings.from_mapping({"blocking": {"options": {"exact": {"max_block_size": 7}}}, "random_seed": 5})
    assert s.blocking["exact"]["max_block_size"] == 7 and s.blocking["tfidf"]["top_k_name"] == 50 and s.random_seed == 5
    with pytest.raises(settings.SettingsError) as error:
        settings.from_mapping({"blocking": {"options": {"char_ngram": {"min_overlap": 2.0, "top_k": "x"}}}, "normalization": {"text": {"unicode_form": "NFX"}}, "random_seed": -1})
    assert len(str(error.value).splitlines()) == 4
    with pytest.raises(TypeError):
        s.blocking["exact"]["max_block_size"] = 1


def test_settings_file(tmp_path):
    (tmp_path / "s.yaml").write_text("dataset:\n  ignore_globs: ['x/**']\n")
    assert settings.load(str(tmp_path / "s.yaml")).dataset["ignore_globs"] == ("x/**",)
    (tmp_path / "bad.yaml").write_text("a: [")
    with pytest.raises(settings.SettingsError):
        settings.load(str(tmp_path / "bad.yaml"))


def test_catalogue(spark, tmp_path):
    for name in ("train/train_source2.tsv", "train/train_source1.tsv", "train/labels.tsv", "test/test_source1.csv", "skip/train_source9.tsv", "train/readme.md"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text("entity_id\nS1-1\n")
    s = settings.from_mapping({"dataset": {"ignore_globs": ["skip/**"]}})
    c = files.Catalogue(tuple(files.discover(spark, str(tmp_path), settings=s)), "train")
    assert [f.source_index for f in c.sources("train")] == [1, 2] and c.ground_truth().role == "ground_truth" and c.source("test", 1).size > 0
    assert {f.split for f in c.readable()} == {"train"} and len(c.files) == 4
    with pytest.raises(FileNotFoundError):
        c.source("test", 2)


def test_last_row_of_a_key_wins(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("entity_id\tn\n" + "".join(f"S1-{i % 3}\t{i}\n" for i in range(30)))
    got = files.needed(files.read_tsv(spark, f"{tmp_path}/a.tsv"), spark.createDataFrame([("S1-0",), ("S1-2",)], "entity_id string"))
    assert {(r.entity_id, r.n) for r in got.collect()} == {("S1-0", "27"), ("S1-2", "29")}


def test_artefacts(spark, tmp_path):
    artefacts.write_json(spark, {"a": [1, float("nan")], "ä": None}, f"{tmp_path}/j")
    assert artefacts.read_json(spark, f"{tmp_path}/j") == {"a": [1, None], "ä": None}
    df = spark.createDataFrame([("x|y", 1.5), (None, 2.0)], "t string, v double")
    text = artefacts.render_markdown("R", {"One": df, "Two": "words"}, 1)
    assert "| x\\|y | 1.5 |" in text and "(the first 1 rows)" in text
    assert "<td>x|y</td>" in artefacts.render_html("R & R", {"One": df}) and "R &amp; R" in artefacts.render_html("R & R", {})
    assert artefacts.render_rules({"b": {"st": "street"}, "a": {}}) == "a: {}\nb:\n  st: street\n"
    assert artefacts.manifest({"rows": None, "n": 3}, str(tmp_path))["rows"] == "PENDING"
    assert not artefacts.is_done(spark, f"{tmp_path}/part")
    artefacts.mark_done(spark, f"{tmp_path}/part")
    assert artefacts.is_done(spark, f"{tmp_path}/part")
    scored = spark.createDataFrame([("S1-1", 0.5, "a"), ("S1-2", 0.6, "b")], "id string, prob double, country string")
    artefacts.write_checkpoint(scored, f"{tmp_path}/ck")
    artefacts.write_checkpoint(scored.filter("country = 'b'").withColumn("prob", F.lit(0.9)), f"{tmp_path}/ck")
    assert {(r.id, r.prob) for r in spark.read.parquet(f"{tmp_path}/ck").collect()} == {("S1-1", 0.5), ("S1-2", 0.9)}


def test_probabilities(spark):
    ok = spark.createDataFrame([(0.0,), (1.0,)], "prob double")
    models.validate_probabilities(ok)
    for bad in (None, float("nan"), float("inf"), -0.1, 1.1):
        with pytest.raises(ValueError):
            models.validate_probabilities(ok.union(spark.createDataFrame([(bad,)], "prob double")))


def test_choice_and_acceptance(spark):
    rows = spark.createDataFrame([("b", 0.9, 0.5, 3), ("a", 0.9, 0.5, 3), ("c", 0.9, 0.4, 1)], "model string, f05 double, average_precision double, fp long")
    assert models.choose(rows) == "a"
    one = lambda name: rows.filter(F.col("model") == name)
    assert not models.accepts(one("a"), one("b")).first().accepted and not models.accepts(one("a"), one("c")).first().accepted
    assert models.accepts(one("c").withColumn("fp", F.lit(9)), one("a")).first().accepted


def test_batch_from_artefacts(spark, world, model_path, tmp_path):
    frames, truth = world
    artefacts.write_json(spark, {"selected_threshold": 0.4}, f"{tmp_path}/t")
    artefacts.write_json(spark, {"top1_only": False}, f"{tmp_path}/r")
    (tmp_path / "s.yaml").write_text("blocking:\n  options:\n    address_token: {enabled: false}\n")
    c = I.config(spark, model_path, f"{tmp_path}/t", f"{tmp_path}/r", f"{tmp_path}/s.yaml")
    assert c.threshold == 0.4 and len(c.columns) == 84 and not c.settings.blocking["address_token"]["enabled"]
    out = I.run_batch(c, frames[1], frames[2], frames[3])
    lists = {r[ANCHOR]: set(filter(None, r.matched_entity_ids.split(","))) for r in out.lists.collect()}
    want: dict = {i: set() for i in lists}
    for r in truth.collect():
        want[r[ANCHOR]].add(r[CANDIDATE])
    assert len(lists) == 120 and sum(lists[i] == want[i] for i in lists) > 100
    models.validate_probabilities(out.scored)
    a = I.audits(out.matches, out.lists, out.candidates, frames[1].select(F.col("entity_id").alias(ANCHOR))).first()
    assert a.anchors == 120 and a.matches_without_candidate == 0 and a.anchors_without_list == 0
    alone = I.run_batch(c, frames[1], None, frames[3].limit(0)).lists
    assert alone.filter("matched_entity_ids <> ''").isEmpty() and alone.count() == 120
    with pytest.raises(ValueError):
        I.run_batch(c, frames[1])


def test_result_files(spark, tmp_path):
    roster = spark.createDataFrame([(f"S1-{i}",) for i in (5, 3, 9, 1)], f"{ANCHOR} string").coalesce(1)
    scored = spark.createDataFrame([("S1-3", "S2-2", 0.9), ("S1-3", "S3-1", 0.95), ("S1-1", "S2-7", 0.2)], f"{ANCHOR} string, {CANDIDATE} string, prob double")
    m, c = S.assemble(roster, R.resolve(scored, 0.5), scored)
    assert [tuple(r) for r in m.collect()] == [("S1-5", ""), ("S1-3", "S3-1,S2-2"), ("S1-9", ""), ("S1-1", "")]
    paths = [f"{tmp_path}/m", f"{tmp_path}/c"]
    assert S.verdict(spark, paths[0], roster, paths[1]) == ("PENDING", None)
    S.write_lists(m, paths[0])
    S.write_lists(c, paths[1])
    known = scored.select(F.col(CANDIDATE).alias("entity_id"))
    status, found = S.verdict(spark, paths[0], roster, paths[1], known)
    assert status == "PASS" and found.isEmpty()
    S.write_lists(c.withColumn("candidate_entity_ids", F.regexp_replace("candidate_entity_ids", "S3-1", "S3-8")), paths[1])
    status, found = S.verdict(spark, paths[0], roster, paths[1], known)
    assert status == "FAIL" and {(r.file, r.rule, r.severity) for r in found.collect()} == {("candidate", "unknown_id", "error"), ("matching", "not_subset", "error")}
    assert S.verdict(spark, paths[0], roster, paths[1], lenient=True)[0] == "PASS"
    assert S.verdict(spark, paths[0], roster, lenient=True)[0] == "PASS"


@pytest.mark.parametrize("text, rule", [("a,b\nS1-1,S2-1\n", "comma_separated"), ("x\ty\nS1-1\t\n", "bad_header"), ("source1_entity_id\tmatched_entity_ids\nS1-1\n", "no_tab"), ("source1_entity_id\tmatched_entity_ids\nS1-1\tS1-1\n", "self_match"), ("source1_entity_id\tmatched_entity_ids\nS1-1\tX-1\n", "bad_prefix")])
def test_broken_files(spark, tmp_path, text, rule):
    (tmp_path / "f.tsv").write_text(text)
    roster = spark.createDataFrame([("S1-1",)], f"{ANCHOR} string")
    found = {r.rule for r in S.validate_file(S.read_lines(spark, f"{tmp_path}/f.tsv"), S.MATCHES, roster).collect()}
    assert rule in found


def test_importances_and_metadata(spark, model_path):
    model, metadata = models.load(spark, model_path)
    rows = models.importances(model, metadata["columns"]).collect()
    assert rows[0].share == 1.0 and rows[0].splits > 0 and len(rows) == 84 and metadata["threshold"] == 0.5
    assert artefacts.feature_metadata(M.feature_registry())["feature_count"] == 84
