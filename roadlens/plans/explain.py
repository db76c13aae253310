"""Plan inspection (V5): the physical plan as text, and checks on it."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_EVAL_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def join_strategies(df: DataFrame) -> list[str]:
    """Physical join operators in the plan, e.g. ``BroadcastHashJoin``."""
    return re.findall(r"\b(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                      r"CartesianProduct)\b", plan_text(df, "simple"))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def uses_python(df: DataFrame) -> bool:
    text = plan_text(df, "simple")
    return any(node in text for node in PYTHON_EVAL_NODES)
