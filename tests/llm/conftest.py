import pytest
from pyspark.sql import functions as F

CLASHING = (
    "id", "n", "size", "rank", "score", "part", "bucket", "cell", "row_number", "before", "length",
    "place", "piece", "source_size", "target", "block", "query", "ids", "stats", "own", "_tie", "_at",
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def prose(seed: int, words: int) -> str:
    out = []
    for i in range(words):
        seed = (seed * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(seed >> 40) % len(WORDS)] + str((seed >> 30) % 50))
    return " ".join(out)


def edge_rows() -> list[tuple]:
    base = prose(7, 60)
    return [
        (1, base, "en", "a", 0),
        (1, base, "en", "a", 0),
        (2, base.replace(" ", "\n", 3).upper(), "en", "b", 0),
        (3, None, "en", None, None),
        (4, "", None, "a", 0),
        (5, " \t\n ", "en", None, 3),
        (None, base + " tail", "en", "c", 0),
        (None, None, None, None, None),
        (6, "one two", "en", "ä", 0),
        (7, "One  two", "en", "ä", 0),
        (8, prose(9, 30_000), "en", "b", 0),
        (9, "x" * 50_000, "en", "zero", 0),
        (10, "a <|endoftext|> b  c  'll I'll 12,5 \n", "fr", "c", 0),
        (20, prose(11, 40) + " " + base, "en", "a", 0),
        (-3, "日本語のテキスト 🙂 naïve", "ja", "c", 0),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df):
    return df.withColumns({c: F.lit(f"not {c}") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="session")
def edges(spark):
    return clashing(spark.createDataFrame(edge_rows(), SCHEMA))


@pytest.fixture(scope="session")
def nothing(spark):
    return clashing(spark.createDataFrame([], SCHEMA))
