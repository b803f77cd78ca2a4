import os

import pytest

LONG = "\n".join(f"the cat {k} sat on the mat and the dog ran by." for k in range(3000))
TABLES = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long", [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "twice", "en", "a", 5), (2, "twice", "en", "a", 5), (3, "Ünï 漢字 😀 a\tb  c ", "de", "b", 3), (4, "you vile idiot hate scum", "en", "a", 24), (5, LONG, "en", "a", len(LONG)), (6, LONG + " once", "en", "b", len(LONG) + 5), (7, "▁ <|endoftext|> \x00", "fr", "a", 5)]),
    "pages": ("page_id long, url string, html string", [(1, None, None), (2, "u", ""), (2, "u", "<p>x</p>"), (3, "v", "<p>x</p>"), (3, "v", "<p>x</p>"), (4, "long", "<b>" + "y " * 200_000)]),
    "embeddings": ("vec_id long, embedding array<float>, label int", [(0, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (51, [0.0, 0.0], 1), (52, None, None), (53, [1.0, None], 1), (54, [float("nan"), 1.0], 1), (55, [0.5, 0.5], 1), (56, [0.5, 0.5], None)]),
    "labels": ("doc_id long, quality int, toxic int", [(2, 1, 0), (3, 1, 0), (4, 0, 1), (5, 1, 0)]),
}


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    from sequora.llm.common import prepare

    prepare(spark)


def _folder(spark, where, keep):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows if keep else [], schema).coalesce(1).write.parquet(f"{where}/{name}.parquet")
    return str(where)


@pytest.fixture(scope="session")
def small_folder(spark, tmp_path_factory):
    """Tables of a few rows with nulls, repeats, empty and long texts."""
    return _folder(spark, tmp_path_factory.mktemp("small"), True)


@pytest.fixture(scope="session")
def empty_folder(spark, tmp_path_factory):
    return _folder(spark, tmp_path_factory.mktemp("empty"), False)


@pytest.fixture(scope="session")
def duck(small_folder):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        assert os.path.isdir(f"{small_folder}/{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_folder}/{t}.parquet/*.parquet'")
    return c
