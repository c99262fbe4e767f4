from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.sources import files
from tessera.streaming.matching import RECORD, anchor_stream, match_stream


def test_tsv_round_trip(spark, tmp_path):
    path = f"{tmp_path}/train_source1"
    df = spark.createDataFrame([("S1-1", "NA", None), ("S1-2", 'quo"te', "x")], "entity_id string, business_name string, business_address string")
    files.write_tsv(df.coalesce(1), path)
    back = {r.entity_id: r for r in files.read_tsv(spark, path).collect()}
    assert back["S1-1"].business_name == "NA" and back["S1-1"].business_address is None and back["S1-2"].business_name == 'quo"te'
    assert files.read_tsv(spark, path, ["business_name"]).columns == ["business_name"]


def test_discovery(spark, tmp_path):
    for name in ("train/source1.tsv", "train/ground_truth.tsv", "test/source2.tsv", "test/skip.tmp.tsv"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text("entity_id\nS1-1\n")
    found = {(f.split, f.role, f.source_index) for f in files.discover(spark, str(tmp_path), ignore=("*.tmp.tsv",))}
    assert found == {("train", "source", 1), ("train", "ground_truth", None), ("test", "source", 2)}


def test_needed_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "entity_id string, n int")
    assert files.needed(df, df.filter("n = 1")).count() == 1


def test_stream(spark, tmp_path):
    rows = [("S1-1", "blue owl", "1 main st", "US"), ("S1-2", "red fox", None, "US")]
    spark.createDataFrame(rows, RECORD).write.parquet(f"{tmp_path}/in")
    candidates = spark.createDataFrame([("S2-1", "blue owl", None, "US")], RECORD)
    match = lambda a, c: B.union_pairs(B.key_join(B.name_token_keys(a), B.name_token_keys(c)))
    q = match_stream(anchor_stream(spark, f"{tmp_path}/in"), candidates, match, f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").filter(F.col("candidate_entity_id") == "S2-1").count() == 1
