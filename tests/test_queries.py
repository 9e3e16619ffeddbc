"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from cinderpost.operators import tokens

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    outcome = check.compare(spark, con, FOLDER, name)
    assert outcome.startswith("equal" if name in oracle_sql() else "rows only"), outcome


def test_entry(spark):
    assert entry(spark).count() == 1


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["logistic_train", "mlp_train", "sequence_classify"])
def test_learners_against_the_larger_class(spark, name):
    """Every learner, the hidden layer too, does better than the larger class."""
    row = queries()[name](spark, "/root/testdata/sf0.01").first()
    assert (row["tn"] + row["fp"], row["fn"] + row["tp"]) == (15, 112)
    assert row["accuracy"] > 112 / 127


def test_vectors_are_computed_once_for_a_distinct_term(spark):
    """No filter repeats them below the step that makes the terms distinct."""
    plan = queries()["random_vectors"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert "md5" in plan and not any("md5" in line for line in filters)


def test_stored_stages_tokenize_a_post_once(spark, monkeypatch):
    read, tokenize = [], tokens.with_tokens

    def seen(posts, *options):
        read.append(posts.count())
        return tokenize(posts, *options)

    monkeypatch.setattr(tokens, "with_tokens", seen)
    queries()["stored_stages"](spark, FOLDER)
    assert sum(read) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
