"""The text queries that SQL can express, against DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import compare  # noqa: E402

from stationlake.llm import catalog  # noqa: E402

SF = Path("/root/testdata/sf0.001")


def test_all_are_registered():
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_its_oracle(spark, name):
    verdict = compare(spark, name, str(SF))
    assert verdict.startswith("ok ") and "types" not in verdict, verdict
