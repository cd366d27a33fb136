import pytest
from pyspark.sql import functions as F

from llm.cases import ODD_TEXTS, SMALL
from orderloom.llm import common


@pytest.fixture(scope="session")
def documents(spark):
    return common.read_table(spark, SMALL, "documents")


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) rows, with columns whose names clash with the operators' own."""

    def make(rows, columns=("doc_id", "text")):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        extra = {"score": 1, "label": 2, "node": 3, "n": 4, "length": 5, "kept": True, "_id": 6, "_text": "t", "_hash": 7, "start": 8}
        extra |= {"_text_hash": "u", "_sha_row": "v", "_prediction": "w", "_html": "x"}
        return df.withColumns({k: F.lit(v) for k, v in extra.items()}).withColumns(
            {"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")}
        )

    return make


@pytest.fixture()
def odd_docs(make_docs):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    # A repeated row, a repeated id with another text, and rows without an id.
    return make_docs([*rows, (5, "Word"), (5, "another text"), (None, "a"), (None, None), (None, "a")])
