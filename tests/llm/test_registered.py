"""Every corpus query: registered once, whole tables, and equal to its SQL where it has some."""

import pytest

from check_oracles import compare, connect
from tidemark.llm import ORACLES, QUERIES


def test_names():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14)) and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_over_the_smallest_tables(spark, sf_dir, name):
    source = {"op4": "embeddings", "op8": None, "op7": None, "op9": "pages", "op11": "pages", "op12": None, "op13": None}.get(name.split("_")[0], "documents")
    df = QUERIES[name](spark, sf_dir)
    assert source is None or df.count() == spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
    assert df.count() > 0


@pytest.mark.parametrize("name", ["op3_line_dedup", "op6_mix_sources", "op7_secret_scan", "op9_url_filter"])
def test_native_operators_plan_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))
