import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402

from oracle import ORACLE  # noqa: E402
from stationlake.catalog import QUERIES  # noqa: E402

SF = Path("/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, name):
    verdict = compare(spark, name, str(SF))
    assert verdict.startswith("ok ") and "types" not in verdict, verdict


@pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")
def test_plans_have_no_nested_loops_or_python(spark):
    for name in ("gold_daily_summary", "gold_data_quality", "gold_station_daily", "dlq_dedup"):
        text = entry.queries()[name](spark, str(SF))._jdf.queryExecution().toString()
        for word in ("NestedLoop", "CartesianProduct", "EvalPython", "MapInPandas"):
            assert word not in text, (name, word)
