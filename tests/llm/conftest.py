import pytest


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    """(doc_id, text) of every document."""
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


ODD_TEXTS = [
    None, "", " ", "\n\t ", "a", "one two", "x " * 3000, "same text " * 60, "same text " * 60,
    "naïve café — “quotes” 漢字 🙂 " * 20, "a b c\na b c\n\na b c\n", "tie tie tie tie tie tie",
    "z" * 5000, "line\x00zero\x1fend",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents, among them repeated rows, null ids and clashing columns."""
    table = [(i, t, None if i % 3 else "en", "src", len(t or ""), f"x{i}") for i, t in enumerate(ODD_TEXTS)]
    table += [table[7], (None, "lost id " * 30, None, None, None, None), (None, None, None, None, None, None)]
    return spark.createDataFrame(
        table, "doc_id long, text string, lang string, source string, n_chars long, host string"
    )


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
