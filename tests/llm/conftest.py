import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, keys string, hits string"


@pytest.fixture(scope="session")
def make(spark, tmp_path_factory):
    """Documents from (id, text) with columns whose names clash with results."""

    def build(rows):
        data = [(i, t, "en", "s", None if t is None else len(t), "x", "k", "h") for i, t in rows]
        return spark.createDataFrame(data, COLUMNS)

    return build


ODD = [(1, None), (2, ""), (3, "  \n "), (4, "a"), (5, "same text here again"), (6, "same text here again"), (6, "same text here again"), (7, "lang " * 30000), (None, "no id"), (8, "日本語 текст 😀 café")]
