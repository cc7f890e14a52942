"""The registered queries: names, SQL and whole tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import compare, connect
from llm import queries
from llm.shared import table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


def test_names():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", ["op1_line_dedup", "op12_conversation_trie", "op13_lexical_search"])
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), SF, name) is None


@pytest.mark.parametrize("name", ["op2_best_fit_packing", "op4_simhash_near_dedup", "op5_html_main_text", "op6_source_mixing", "op8_token_files", "op9_toxicity", "op10_quality_classifier", "op3_embedding_near_dedup", "op11_byte_bpe"])
def test_every_row_has_a_result(spark, name):
    source, key = {"op5_html_main_text": ("pages", "page_id"), "op3_embedding_near_dedup": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    made = queries.queries()[name](spark, SF)
    assert {r[0] for r in made.select(key).collect()} == {r[0] for r in table(spark, SF, source).select(key).collect()}


def test_native_operators_run_no_python(spark):
    for name in ("op1_line_dedup", "op6_source_mixing"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
