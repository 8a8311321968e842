import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from llm_cases import SF

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def table(spark):
    def read(name, sf=SF):
        return spark.read.parquet(f"{sf}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of given (doc_id, text, lang, source) rows, with a column of a clashing name."""

    def make(rows, extra=""):
        data = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(data, DOCUMENTS).repartition(3)
        for name in extra.split():
            df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make
