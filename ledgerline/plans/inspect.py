"""Plan inspection: the text of ``explain`` for checks on pushdown, pruning and exchanges."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def scan_filters(df: DataFrame) -> dict[str, list[str]]:
    """PartitionFilters / PushedFilters lines of the scans in ``df``'s plan."""
    found: dict[str, list[str]] = {"PartitionFilters": [], "PushedFilters": [], "ReadSchema": []}
    for line in plan_text(df).splitlines():
        for key in found:
            if line.strip().startswith(key + ":"):
                found[key].append(line.split(":", 1)[1].strip())
    return found
