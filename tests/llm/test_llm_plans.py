"""Plans of the operators that use DataFrame functions only."""

import pytest

from conftest import SF_SMALL
from __spark_entry__ import queries

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")
NATIVE = ("op5_", "op6_")


@pytest.mark.parametrize("name", sorted(n for n in queries() if n.startswith(NATIVE)))
def test_native_operators_stay_in_the_jvm_and_never_pair_rows(spark, name):
    plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PYTHON_NODES + PAIR_NODES if n in plan], plan
