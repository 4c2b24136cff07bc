import pytest

from tests.conftest import SF_ORACLE

ODD = [
    # id, text, lang, source, n_chars
    (1, "the quick brown fox\njumps", "en", "a", 25),
    (2, "the quick  brown fox jumps", "en", "a", 26),
    (2, "the quick  brown fox jumps", "en", "a", 26),          # repeated row
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \t\n\x0b\x0c\r ", "de", "b", 7),
    (None, "the quick brown fox jumps", None, "a", 25),
    (None, None, None, None, None),
    (6, "word " * 60_000, "en", "c", 300_000),                   # very long
    (7, "x" * 100_000, "en", "c", 100_000),                      # one very long word
    (8, "Ünïcödé \U0001f600 Straße\n\n\ntail\n", "de", "c", 20),
    (9, "mail a.b@c.example.com or +1 (988) 555-2485, 4111 1111 1111 1111, 10.0.0.255", "en", "c", 70),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASH = ["id", "t", "k", "score", "kept", "keep_id", "sha", "fp", "ids", "decoded", "size", "copies", "gone", "stay",
         "lines", "n_words", "Quality_Score", "sieve_p", "drop_key", "mix_k", "quality", "component_id"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names."""
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASH])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_ORACLE}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
