import duckdb
import pytest

SF = "/root/testdata/sf0.001"

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "one two",
    "Ünïcode wörds are here ☃ and there \U0001f600 again",
    "x" * 300_000,
    ("lorem ipsum dolor sit amet consectetur " * 9000).strip(),
    "same line that is long enough to be compared here\n" * 3,
    "same line that is long enough to be compared here",
    "same line that is long enough to be compared here",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, more columns with clashing names."""
    rows = [(i, t, ["en", "de", None, "xx"][i % 4], ["a", None][i % 2], len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[9], (None, "a text without an id, of several words", None, None, None), (5, "other text of the same id", "en", "a", 3)]
    rows = [(*r, 1.5, "clash", 7) for r in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, n long"
    ).repartition(3, "text")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
