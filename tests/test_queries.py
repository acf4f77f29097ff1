"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    message, _ = compare(spark, con, FOLDER, queries()[name], oracle_sql()[name])
    assert message is None, message


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("texts", [["", "ab", "abc", None], ["", None], [None], []])
def test_excerpt_lengths_of_empty_texts_match_sql(spark, tmp_path, texts):
    documents = spark.createDataFrame([(i, t, "src1") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    for name, df in (("documents", documents), ("labels", labels)):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    message, _ = compare(spark, con, str(tmp_path), queries()["excerpt_stats"], oracle_sql()["excerpt_stats"])
    assert message is None, message


def test_excerpts_are_measured_before_the_join(spark):
    plan = queries()["excerpt_stats"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("length(")
