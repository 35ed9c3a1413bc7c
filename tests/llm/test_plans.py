"""Native operators run no Python on the executors."""

import pytest

from terracheck.llm import catalog, licenses, secrets, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("query", [simhash.op3_document_fingerprints, licenses.op8_license_scans, licenses.op8_license_notices, secrets.op9_secret_scans])
def test_native_plans(spark, query):
    plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct"))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cartesian_or_row_python_in_any_query(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
