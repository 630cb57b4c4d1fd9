"""The registered queries and the pipeline over a whole small table."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from headway.llm.common import table
from headway.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_query_runs_over_the_whole_table(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    documents = {"op1", "op2", "op3", "op6", "op8", "op9", "op11", "op12"}
    if name.split("_")[0] in documents:
        assert len(rows) == table(spark, SF, "documents").count()
    assert rows


@pytest.mark.parametrize("name", SQL)
def test_query_agrees_with_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for t in ("conversations", "documents", "embeddings", "pages", "labels"):
        base.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    expected = base.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected.fetchall()))


def test_queries_without_numbers_of_python_stay_native(spark):
    for name in ("op3_weak_supervision", "op4_chat_perspectives", "op7_host_reputation"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == columns and after.schema == docs.schema, name
        docs = after.cache()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.where("piece = 0").count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
