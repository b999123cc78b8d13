"""Plan inspection helpers (used by tests and the benchmark)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "FlatMapGroupsInArrow", "MapInArrow", "PythonUDF")


def physical_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The plan text as ``explain(mode)`` prints it."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_exchanges(df: DataFrame) -> int:
    """Distinct shuffle exchanges in the (initial) physical plan, broadcasts
    excluded; an exchange that appears in several branches (a reused
    subquery or subplan) counts once."""
    text = physical_plan(df, "simple")
    found = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition|"
                       r"RoundRobinPartitioning\(\d+\)|roundrobinpartitioning\(\d+\))[^\n]*?\[plan_id=(\d+)\]", text)
    return len({plan_id for _, plan_id in found})


def count_broadcasts(df: DataFrame) -> int:
    return len(re.findall(r"BroadcastExchange", physical_plan(df, "simple")))


def python_nodes(df: DataFrame) -> list[str]:
    text = physical_plan(df, "simple")
    return [n for n in _PY_NODES if n in text]


def scans(df: DataFrame) -> list[str]:
    """One line per FileScan: the file, pushed filters and read schema."""
    out = []
    for line in physical_plan(df, "simple").splitlines():
        if "FileScan" in line:
            loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]+)\]", line)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            schema = re.search(r"ReadSchema: (\S+)", line)
            out.append(" ".join(x.group(1) for x in (loc, pushed, schema) if x))
    return out
