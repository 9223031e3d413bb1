"""Plan inspection helpers (the EXPLAIN ANALYZE of the reference)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*?)\]", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<.*?>)\n", plan_text(df))


def has_python_udf(df: DataFrame) -> bool:
    text = plan_text(df)
    return any(tok in text for tok in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"))


def exchanges(df: DataFrame) -> int:
    return len(re.findall(r"\bExchange\b", plan_text(df)))


#: Metrics of a plan node, by Spark's names for them.
_ROWS, _WRITTEN, _FILES = "numOutputRows", "shuffleRecordsWritten", "numFiles"


def plan_metrics(df: DataFrame) -> list[dict]:
    """D6, with rows and times: one entry per node of the plan as it ran (after adaptive re-planning).

    Runs ``df`` to its end on the executors (only a count comes back) and reads the nodes' SQL metrics:
    ``node``, ``depth``, ``detail``, ``rows`` (out; of an exchange the records written), ``files`` and
    ``time_ms`` (the sum of the node's own timings), None where Spark keeps no such metric."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    out: list[dict] = []

    def values(node) -> dict[str, tuple[str, int]]:
        kept, each = {}, node.metrics().iterator()
        while each.hasNext():
            pair = each.next()
            kept[pair._1()] = (pair._2().metricType(), int(pair._2().value()))
        return kept

    def walk(node, depth: int) -> None:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan(), depth)
        if name.endswith("QueryStageExec"):
            return walk(node.plan(), depth)
        got = values(node)
        rows = got.get(_ROWS) or got.get(_WRITTEN)
        times = [v / 1e6 if kind == "nsTiming" else v for kind, v in got.values() if kind in ("timing", "nsTiming")]
        out.append({"node": node.nodeName().strip(), "depth": depth, "detail": node.simpleString(200),
                    "rows": rows[1] if rows else None, "files": got[_FILES][1] if _FILES in got else None,
                    "time_ms": round(sum(times), 3) if times else None})
        each = node.children().iterator()
        while each.hasNext():
            walk(each.next(), depth + 1)
    walk(execution.executedPlan(), 0)
    return out


def rows_out(df: DataFrame, node: str) -> list[int]:
    """Rows out of every node of the executed plan whose name begins with ``node``."""
    return [n["rows"] for n in plan_metrics(df) if n["node"].startswith(node) and n["rows"] is not None]


def explain_analyze(df: DataFrame) -> str:
    """The executed plan as text, a line a node, with rows and times."""
    return "\n".join(f"{'  ' * n['depth']}{n['node']}  rows={n['rows']} files={n['files']} time_ms={n['time_ms']}"
                     for n in plan_metrics(df))
