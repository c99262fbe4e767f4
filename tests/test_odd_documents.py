"""Queries equal their SQL on empty, null and odd texts, and on several files of unequal size."""

import pytest

ODD = [None, "", " ", "... !!!", "İstanbul gmbh und co", "ltd", "the of and", "café naïve", "a b c d e f g h i j k l m n o p q", "alpha beta gamma"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The first file is small, the last one large, as Spark deals out large files first."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = tmp_path_factory.mktemp("odd")
    (root / "documents.parquet").mkdir()
    n = 900
    rows = pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": [ODD[i * 7 % len(ODD)] for i in range(n)], "lang": ["en"] * n, "source": ["s"] * n, "n_chars": pa.array([0] * n, pa.int64())})
    for k, (a, b) in enumerate(((0, 5), (5, 150), (150, n))):
        pq.write_table(rows.slice(a, b - a), root / "documents.parquet" / f"part-{k}.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([3, 700], pa.int64()), "quality": [1, 1], "toxic": [1, 1]}), root / "labels.parquet")
    return str(root)


def _both(spark, folder, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t, path in (("documents", "documents.parquet/*.parquet"), ("labels", "labels.parquet")):
        con.execute(f"create view {t} as select * from '{folder}/{path}'")
    found = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    got = [tuple(r[c] for c in columns) for r in entry.queries()[name](spark, folder).collect()]
    return sorted(got, key=repr), sorted(found.fetchall(), key=repr)


@pytest.mark.parametrize("name", ["scan_leading_sample", "source_pool"])
def test_leading_rows_are_those_of_the_first_files(spark, folder, name):
    got, want = _both(spark, folder, name)
    assert got == want


@pytest.mark.parametrize("name", ["er_records", "norm_name_repr", "norm_representations"])
def test_empty_and_odd_names(spark, folder, name):
    got, want = _both(spark, folder, name)
    assert got == want
