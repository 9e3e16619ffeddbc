import os

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "size long, taken string, _row string, _key string, n_hit string, score string, host string, class_id string"


@pytest.fixture(scope="session")
def tables():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return folder


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns named like results."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), *["x"] * 0, 7, *["x"] * 7)
            for r in rows
        ]
        return spark.createDataFrame(full, f"{SCHEMA}, {CLASH}")

    return make
