"""Every registered query against its DuckDB statement at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import compare, oracle

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF, name) == []


def test_only_the_file_inventory_has_no_oracle(spark):
    assert set(entry.queries()) - set(entry.oracle_sql()) - set(entry.LLM) == {"file_inventory"}
    found = {r.path.rsplit("/", 1)[-1]: r.length for r in entry.queries()["file_inventory"](spark, SF).collect()}
    assert found == {p.name: p.stat().st_size for p in Path(SF).glob("*.parquet")}


def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns == ["bairro", "total_ocorrencias"]
    assert entry.entry(spark).count() == 5


def test_no_plan_holds_a_cross_or_nested_loop_join(spark):
    for name, query in entry.queries().items():
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_matrix_cells_add_up_to_the_long_form(spark):
    queries = entry.queries()
    wide = queries["top10_place_year_matrix"](spark, SF).toPandas().set_index("bairro")
    long = queries["top10_place_year"](spark, SF).toPandas()
    assert wide.to_numpy().sum() == long.total_ocorrencias.sum()
