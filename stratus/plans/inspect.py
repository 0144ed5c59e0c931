"""Plan inspection through ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    """Counts of the operators that decide cost at scale (formatted plan,
    final plan as far as AQE has decided it before execution)."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n")[0]
    return {
        "exchanges": len(re.findall(r"Exchange", tree)),
        "hash_exchanges": len(re.findall(r"Arguments: hashpartitioning", text)),
        "single_partition_exchanges": len(re.findall(r"Arguments: SinglePartition", text)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", tree)),
        "windows": len(re.findall(r"\bWindow\b", tree)),
        "python_udfs": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", tree)),
    }
