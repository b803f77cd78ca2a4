"""Tables of a database, against the rows that were put there; the database is the one that Spark brings along."""

import uuid

import pytest

from sequora.sources import database as db
from sequora.sources.contracts import SOURCE_COLUMNS, check_tables

COLUMNS = ["id", "other"]
KEYS = {
    "numbers": [(f"T{k:08d}", "x") for k in range(3000)],
    "a hot key": [("hot", f"v{k:04d}") for k in range(900)] + [(f"k{k}", None) for k in range(300)],
    "equal rows": [("same", "same")] * 500 + [("same", None)] * 40 + [("other", "o")],
    "nulls": [(None, f"n{k}") for k in range(400)] + [(None, None)] * 3 + [("", "empty"), ("", "empty")],
    "one within another": [("a" * k, str(k)) for k in range(1, 300)],
    "quotes": [(f"it's {k}'", "%_'") for k in range(300)] + [(f"é中{k}", "ß") for k in range(200)],
    "one": [("x", "y")],
}


@pytest.fixture(scope="module")
def url():
    return f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"


def put(spark, url, name, rows, columns=COLUMNS):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).coalesce(1)
    # Spark can't write a null to a VARCHAR here
    df.fillna("<null>").write.option("createTableColumnTypes", ", ".join(f"`{c}` VARCHAR(400)" for c in columns)).jdbc(url, name)
    held = spark._jvm.java.sql.DriverManager.getConnection(url)
    for c in columns:
        held.createStatement().executeUpdate(f"""ALTER TABLE {name} ALTER COLUMN "{c}" NULL""")
        held.createStatement().executeUpdate(f"""UPDATE {name} SET "{c}" = NULL WHERE "{c}" = '<null>'""")
    held.close()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x or "") for x in r])


@pytest.mark.parametrize("case", KEYS)
def test_every_row_once(spark, url, case):
    name = case.replace(" ", "_")
    put(spark, url, f'"{name}"', KEYS[case])
    df = db.read_table(spark, url, name, COLUMNS, rows_per_read=100)
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string"]
    assert ordered(df.collect()) == ordered(KEYS[case])
    sizes = [len(p) for p in df.rdd.glom().collect()]
    assert max(sizes) <= (500 if case == "equal rows" else 100) and len(sizes) <= 2 * len(KEYS[case]) / 100 + 3
    assert len(sizes) > 1 or case == "one"


def test_an_empty_table_and_a_missing_one(spark, url):
    put(spark, url, '"none"', [])
    assert db.read_table(spark, url, "none", COLUMNS, rows_per_read=10).collect() == []
    with pytest.raises(Exception, match="(?i)does not exist"):
        db.read_table(spark, url, "nowhere", COLUMNS)


def test_the_source_tables(spark, url):
    for t, columns in SOURCE_COLUMNS.items():
        put(spark, url, f'"{t}"', [tuple(f"{c}{k}" for c in columns) for k in range(5)], columns)
    found = db.load_database(spark, url, rows_per_read=3)
    check_tables(found)
    assert {t: (df.columns, df.count()) for t, df in found.items()} == {t: (c, 5) for t, c in SOURCE_COLUMNS.items()}


def test_few_questions_for_long_shared_starts():
    rows, asked = [f"{'0' * 60}{k:04d}" for k in range(2000)], []

    def ask(sql):
        asked.append(sql)
        if sql.startswith("SELECT COUNT"):
            return [(len(rows),)]
        n = int(sql.split("SUBSTR(k, 1, ")[1].split(")")[0])
        groups = {}
        for r in rows:
            groups.setdefault(r[:n], []).append(r)
        return [(p, len(g), min(g), max(g)) for p, g in groups.items()] if len(groups) < 50 else pytest.fail("too fine")

    assert sum(n for _, n in db.pieces(ask, "t", ["k"], 1000)) == 2000
    assert len(asked) == 3
