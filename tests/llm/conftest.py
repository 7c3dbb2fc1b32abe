import pytest

#: Null and repeated rows, empty and long texts, ties, and columns whose names operators also use.
EDGE = [
    (1, "the cat sat on the mat and the dog ran off to sea", "en", "a", 1),
    (1, "the cat sat on the mat and the dog ran off to sea", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (None, "the cat sat on the mat and the dog ran off to sea", None, None, 2),
    (4, "alpha beta " * 3000, "en", "b", 3),
    (5, " \n\t ", "fr", "b", 4),
    (6, "\x0bça va\x0c\r\n— 12 34", "fr", "b", 4),
    (7, "the cat sat on the mat and the dog ran off to sea today", "en", "c", 5),
    (8, "123 !!", None, "c", 5),
]
SCHEMA = "doc_id long, text string, lang string, bucket string, `row` long"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
