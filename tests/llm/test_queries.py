import pytest

import corpus_pipeline
from check_oracle import duck, rows_of
from outcomekit.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cursor = duck(SF).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_other_queries_give_rows(spark, name):
    table = "pages" if name.startswith(("op5_", "op6_")) else "documents"
    n = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    got = QUERIES[name](spark, SMALL).count()
    assert got > 0 if name.startswith("op9_") else got == n


def test_pipeline_keeps_columns_and_narrows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows, now = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns, name
        now = spark.createDataFrame(now.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
    assert last.count() == now.count() and 0 < now.select("doc_id").distinct().count() < rows
    assert corpus_pipeline.run(spark, SMALL).count() == last.count()
    assert len(corpus_pipeline.STAGES) == 5
