"""Plan checks: the shapes the library promises, asserted on physical plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned_windows(df: DataFrame, data_columns: set[str]) -> list[str]:
    """Window operators without a partition key whose input carries any of
    ``data_columns`` (i.e. data rows, not a per-partition summary). An empty
    list is the promised shape: no single-task window over data rows."""
    found = []
    jplan = df._jdf.queryExecution().executedPlan()
    stack = [jplan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "Window" and node.partitionSpec().isEmpty():
            cols = {a.name() for a in _iter(node.child().output())}
            if cols & data_columns or not data_columns:
                found.append(node.toString())
        stack.extend(_iter(node.children()))
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
    return found


def _iter(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def broadcast_joins(df: DataFrame) -> int:
    """Number of broadcast joins in the physical plan."""
    return _plan_text(df).count("BroadcastHashJoin") + _plan_text(df).count("BroadcastNestedLoopJoin")
