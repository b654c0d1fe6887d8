import pytest

VOCAB = pytest.importorskip("public_tokenizers")

#: Nulls, empty and blank texts, ties, repeated rows, a long text, clashing names.
LONG = " ".join(f"word{i % 977} tail{i % 31}." for i in range(60_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the dog all day long.", "en", "a", "x"),
    (2, "The cat  sat on the mat\nand looked at the dog all day long.", "en", "a", "x"),
    (3, "The cat sat on the mat and looked at the dog all day long.", "en", "a", None),
    (4, "Le chat est sur le tapis et regarde le chien toute la journée.", "fr", "b", "y"),
    (5, None, "en", None, "y"),
    (6, "", None, "b", "y"),
    (7, " \n\t ", "fr", "b", "y"),
    (None, "Le chien dort sous la table de la cuisine.", "fr", "b", "y"),
    (8, "one two", None, "c", "z"),
    (9, "1234 !!! <|endoftext|>", "en", "c", "z"),
    (10, LONG, "en", "c", "z"),
    (10, LONG, "en", "c", "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, row string"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
