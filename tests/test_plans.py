"""Plan shape of every registered query (planning only, no execution):
no cartesian products, nested-loop joins or sort-merge joins against the
gold tables; every scan reads a pruned column list."""

import re

import pytest

from farebox.plans.catalog import all_queries

from .conftest import SF0001

QUERIES = all_queries()
ROW_LEVEL = {"fact_trips", "dedup_trips", "valid_trips", "rejected_trips", "sample_hash", "trip_cube"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SF0001)
    txt = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    plan = txt.split("\n\n")[0]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert bad not in plan, f"{name}: {bad}"
    # outside the row-level layer outputs, no scan of a gold table reads every column
    if name not in ROW_LEVEL:
        for loc, schema in re.findall(r"Location: InMemoryFileIndex \[([^\]]*)\].*?ReadSchema: struct<([^>]*)>",
                                      txt, flags=re.S):
            if "/fact_trips" in loc:
                fields = re.findall(r"(\w+):", schema)
                assert len(fields) <= 12, f"{name} reads {fields}"
