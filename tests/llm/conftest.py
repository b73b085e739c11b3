import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
LONG = "word " * 60_000 + "end"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


ODD_ROWS = [
    # doc_id, text, lang, source, then columns whose names operators use themselves
    (1, "The cat sat on the mat and then it ran off", "en", "a", 9, "x", 0.5),
    (1, "The cat sat on the mat and then it ran off", "en", "a", 9, "x", 0.5),
    (2, "the cat  sat on\nthe mat and then it ran off", None, "a", None, None, None),
    (3, "", "en", "b", 9, "x", 0.5),
    (4, None, "fr", None, 9, "x", 0.5),
    (5, " \t\n", None, None, 9, "x", 0.5),
    (None, "Le chat est parti de la maison avec un chien noir", "fr", "é", 9, "x", 0.5),
    (None, None, None, "b", 9, "x", 0.5),
    (7, LONG, "en", "b", 9, "x", 0.5),
    (8, "123 456 !!! 789", "en", "b", 9, "x", 0.5),
    (50, "one", "en", "c", 9, "x", 0.5),
    (51, "é￿ ▁ \U0001f600 <|endoftext|> it's  we'll\r\n", "en", "c", 9, "x", 0.5),
]
ODD_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, position int, key string, score double"
)


CLASHES = ["_key", "_id", "_row", "_copies", "_twins", "_copy", "_mark", "_rows", "lang_pred", "predicted"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ids that repeat, clashing names."""
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns of the names that operators give to their own, all 5."""
    return odd.withColumns({name: F.lit(5) for name in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
