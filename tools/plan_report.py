"""Write PLANS.md: physical-plan shape of every batch, drop and stream query (from explain).

Usage: python tools/plan_report.py [sf_dir]
Counts come from the initial adaptive plan (before AQE's run-time changes).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.drop_queries import DROP_QUERIES  # noqa: E402
from strata.plans.queries import QUERIES  # noqa: E402
from strata.plans.stream_queries import STREAM_QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def shape(text: str) -> dict:
    tree = text.split("\n\n")[0]
    nodes = re.findall(r"(?:\+-|:-|^)\s*([A-Za-z]+)", tree, flags=re.M)
    pushed = [p for p in re.findall(r"PushedFilters: \[(.*)\]", text) if p.strip()]
    return {
        "scans": tree.count("Scan parquet"),
        "exchanges": sum(1 for n in nodes if n == "Exchange"),
        "broadcasts": sum(1 for n in nodes if n == "BroadcastExchange"),
        "partial_aggs": len(re.findall(r"Functions \[\d+\]: \[partial_", text)),
        "windows": sum(1 for n in nodes if n == "Window"),
        "python": sum(1 for n in nodes if "Python" in n or "InPandas" in n),
        "pushed_filters": len(pushed),
    }


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    lines = [
        "# Physical plans of the queries",
        "",
        f"Generated by `tools/plan_report.py` at `{root}` from `explain(\"formatted\")` (initial adaptive",
        "plan; AQE may still turn a sort-merge join into a broadcast or split a skewed partition at run",
        "time). Exchanges are shuffles; a shuffle preceded by a partial aggregate moves at most one row per",
        "key per map task. Builder jobs run before the plan exists: schema reads, skew measurements, header",
        "scans and intermediate tables. A stream's own jobs run under its query and aren't counted; its plan",
        "is the read of its sink.",
        "",
        "| query | builder jobs | scans | shuffles | broadcasts | partial aggs | windows | python | scans with pushed filters |",
        "|---|---|---|---|---|---|---|---|---|",
    ]
    for name, fn in {**QUERIES, **DROP_QUERIES, **STREAM_QUERIES}.items():
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, root)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        s = shape(plan_text(df))
        lines.append(f"| {name} | {jobs} | {s['scans']} | {s['exchanges']} | {s['broadcasts']} | {s['partial_aggs']} | "
                     f"{s['windows']} | {s['python']} | {s['pushed_filters']} |")
    lines += [
        "",
        "## Notes",
        "",
        "- `content_dedupe` scans line items twice on purpose: the query models a re-delivery of the",
        "  same rows. The copies meet in one hash aggregate whose partial step runs before the only shuffle.",
        "- `scd1_latest` has one shuffle after a map-side partial `max`. A key with most of the rows still",
        "  sends one row per map task.",
        "- `scd2_history` / `dim_current`: the key-skew measurement ran before planning and found no hot",
        "  key, so one window shuffle. With a hot key the plan adds a per-(key, bucket) summary and one",
        "  join back.",
        "- `fact_current`: both joins are broadcast here. The calendar's size is bounded by its range;",
        "  the customer dimension is broadcast by the planner from its size estimate, and would be a",
        "  sort-merge join (AQE skew-split) at scale.",
        "- `late_flag` / `late_replay` / `retention`: line items join orders on the order key. At sf0.1",
        "  orders fits the broadcast threshold; at scale this is the one large-large join, on its natural key.",
        "- `change_feed_union` and `join_drop` compute each classification / fact set once (one pass with",
        "  a flag) instead of a union or a count plus a semi-join.",
        "- `guardrails` is the union of the other ops checks; its shuffles are theirs, each after a partial",
        "  aggregate. In the pipeline it reads the stored ops tables instead.",
        "- The CSV header scan is the only Python task: a plan node in `schema_drift` and",
        "  `schema_drift_files`, a builder job in the other drop queries.",
    ]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
