import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text[, lang, source]) as a table like `documents`, with
    extra columns whose names clash with what the operators add."""

    def make(rows):
        rows = [(*r, *([None] * (4 - len(r)))) for r in rows]
        full = [(*r, None if r[1] is None else len(r[1]), 1, 2, 3.0, "x") for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, shard int, taken long, lang_score double, component string")

    return make


@pytest.fixture()
def saved(scratch):
    """Writes a DataFrame as a table of a folder that queries can read."""

    def save(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{scratch}/{name}.parquet")
        return scratch

    return save
