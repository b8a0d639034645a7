import os

import pytest
from compare import compare, connect

from stayline.llm.registry import LLM_ORACLES, LLM_REGISTERED

SF_DIR = os.environ.get("STAYLINE_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_REGISTERED) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op4_toxicity", "op6_main_text", "op7_knn_graph", "op9_bpe", "op10_pii"])
def test_a_row_for_every_row(spark, name):
    table = {"op6_main_text": "pages", "op7_knn_graph": "embeddings"}.get(name, "documents")
    got = LLM_REGISTERED[name](spark, "/root/testdata/sf0.001")
    assert got.count() == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
