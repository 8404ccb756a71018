"""Write the physical plan tree of every batch query to PLANS.md (run: python tools/plans.py [sf_dir])."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.plans.catalog import QUERIES  # noqa: E402
from ledgerline.plans.inspect import plan_text, scan_filters  # noqa: E402
from ledgerline.plans.streams import STREAM_QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def tree(text: str) -> str:
    lines = text.splitlines()
    out = []
    for line in lines[1:]:
        if not line.strip():
            break
        out.append(line)
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    parts = [
        "# Physical plans\n",
        f"Generated by `tools/plans.py` at `{sf_dir}` (local[8], AQE on; `AdaptiveSparkPlan` trees before execution).",
        "Stream queries are omitted (they run a stream; their per-batch plans are the writer's joins).\n",
    ]
    for name, fn in QUERIES.items():
        if name in STREAM_QUERIES:
            continue
        df = fn(spark, sf_dir)
        text = plan_text(df)
        filters = scan_filters(df)
        parts.append(f"## {name}\n\n```\n{tree(text)}\n```\n")
        extra = []
        for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
            vals = [v for v in filters[key] if v and v != "[]"]
            if vals:
                short = [v if len(v) < 160 else v[:157] + "..." for v in vals[:3]]
                extra.append(f"- {key}: " + "; ".join(f"`{v}`" for v in short))
        if extra:
            parts.append("\n".join(extra) + "\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
