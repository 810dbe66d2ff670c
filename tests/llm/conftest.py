import pytest

FOLDER = "/root/testdata/sf0.001"
#: Names that operators use for columns of their own.
CLASHING = ("score", "label", "predicted", "row", "match", "base", "found", "bands", "node", "tree", "edited", "_bucket",
            "pattern", "posterior", "row_key", "__row_key", "own_text", "quoted", "ids")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def odd_texts():
    prose = " ".join(f"word{k} and thing{k * 7 % 97}." for k in range(12_000))
    return [
        (1, None), (2, ""), (3, " \n\n \t"), (4, prose), (5, "the same row twice, with words enough"),
        (5, "the same row twice, with words enough"), (None, "a row without an id, all rights reserved"),
        (None, None), (6, "The same words, five or more of them!"), (7, "the same words five or more of them"),
        (8, "x" * 200_000), (9, "é😀 ​ ' 's\n"), (10, "one two"), (11, "!!!"),
    ]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows, missing ids, and columns whose names clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, None, None, None, *[None] * len(CLASHING)) for i, t in odd_texts()], schema)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (4, 1, 0), (6, 0, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
