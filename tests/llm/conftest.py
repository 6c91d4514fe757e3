import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from gridmix.llm import common
from llm_data import DOCS  # noqa: E402


@pytest.fixture(autouse=True)
def prepared(spark):
    common.prepare(spark)


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text[, source]) rows, with a further column of a clashing name."""
    def build(rows, extra="size"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, "x")
                for r in rows]
        return spark.createDataFrame(full, f"{DOCS}, {extra} string")

    return build
