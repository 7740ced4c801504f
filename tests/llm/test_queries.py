import os

import pytest

from boreal.llm import queries

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": {"record_id": "string", "line_no": "int"}, "p3_found": {"source_id_a": "string", "source_id_b": "string"}, "p4_found": {"record_id_a": "string", "record_id_b": "string"},
    "p5_found": {"example_id_a": "string", "example_id_b": "string"}, "p6_found": {"run_id": "string", "prompt_id": "string", "side": "string", "defect": "string"},
    "p8_found": {"doc_id": "bigint", "item_id": "bigint"}, "p9_found": {"doc_id": "bigint", "lang": "string"},
}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, name):
    df = queries.queries()[name](spark, DATA)
    assert dict(df.dtypes) == COLUMNS[name]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))


def test_every_problem_has_queries():
    assert {q.split("_")[0] for q in queries.queries()} == {f"p{n}" for n in range(1, 10)}
    assert set(queries.oracle_sql()) <= set(queries.queries())
