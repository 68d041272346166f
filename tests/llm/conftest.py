import pytest
from usertide.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and wordless texts, a very long one, repeated rows, and columns of clashing names."""
    long = " ".join(f"w{i % 5000}" for i in range(40_000)) + " " + "x" * 3000
    rows = [
        (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "12 -- 3.5", None), (5, long, "en"), (5, long, "en"),
        (6, long, None), (None, "some words of a text without an id", "en"), (7, "a", "de"), (8, "Ünïcode 日本語 🎉 text", None),
    ]
    names = "id n key a b words spans items score value row_id text_b component host held_out".split()
    extra = ", ".join(f"'{n}' AS {n}" for n in names)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'src' AS source", "1L AS n_chars", *extra.split(", "))
