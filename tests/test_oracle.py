"""Every named query: all rows against its SQL twin, and the shape of its plan."""

import re

import pytest

from quern.plans.catalog import ENTRIES
from tools.compare import connect, frame_difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def single_task_inputs(plan: str) -> list[str]:
    """Operators that send unreduced rows to one task."""
    lines = [re.sub(r"^[\s:+\-]*(\*\(\d+\) )?", "", line) for line in plan.splitlines()]
    bounded = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "LocalLimit", "LocalTableScan", "Window")
    found = []
    for line, child in zip(lines, lines[1:]):
        if line.startswith("Exchange SinglePartition") and not child.startswith(bounded):
            below = lines[lines.index(child) :]
            first = next((x for x in below if x.startswith((*bounded, "FileScan", "Scan"))), "")
            if first.startswith(("FileScan", "Scan")):
                found.append(child)
    return found


@pytest.mark.parametrize("name", list(ENTRIES))
def test_rows_and_plan(spark, duck, name):
    entry = ENTRIES[name]
    frame = entry.run(spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert single_task_inputs(plan) == []
    assert frame_difference(frame, entry, duck) is None
