import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import CLASHING, EDGE_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(EDGE_ROWS, ddl)
    for i, c in enumerate(CLASHING):
        docs = docs.withColumn(c, docs.n_chars + i)
    return docs


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
