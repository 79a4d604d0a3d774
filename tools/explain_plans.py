"""Write the physical plans of the headline queries to docs/PLANS.md.

    python tools/explain_plans.py [folder]

Only the operator tree and the scan lines (pushed filters, read schema) of
``explain("formatted")`` are kept.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.plans.queries import REGISTRY  # noqa: E402
from shoplens.session import build_session  # noqa: E402

HEADLINE = ["session_stats", "session_extract", "top10_categories", "top10_products_universe",
            "top10_active_sessions", "area_top3_products", "area_top3_orders",
            "blacklist_users", "province_top3", "last_hour_trend", "hourly_sliding_clicks",
            "page_flow_conversion"]

NOTES = {
    "session_stats": "one partial+final aggregate per session, user join left to the "
                     "planner/AQE, global bucket counts from per-task partials",
    "session_extract": "partial WindowGroupLimit (cap = sample total) before the (date, hour) "
                       "shuffle; per-hour quotas broadcast",
    "top10_categories": "actions semi-joined to kept sessions, one tagged aggregate, "
                        "TakeOrderedAndProject",
    "area_top3_products": "3-column scan with the date range pushed, broadcast city dimension, "
                          "partial collect_set, partial WindowGroupLimit",
    "area_top3_orders": "only (orderkey, partkey) and (orderkey, nationkey) cross the big join; "
                        "per (nation, part) partial counts before the dimension",
    "hourly_sliding_clicks": "per-minute partial counts first, then the 60-fold window expansion",
    "page_flow_conversion": "lead within (session, minute) chunks plus across chunk ends; "
                            "no window holds a whole session",
}


def tree(text: str) -> str:
    keep = []
    for line in text.splitlines():
        s = line.strip()
        if s.startswith(("PushedFilters", "ReadSchema", "Location")) or (
                s and not s.startswith("(") and not s.startswith(("Input", "Output",
                "Arguments", "Keys", "Functions", "Aggregate", "Results", "Condition",
                "Join", "Left", "Right", "Batched", "Subquery", "Partition", "Order",
                "Build", "Fetch", "Limit", "Group", "Project", "Sort", "Generator",
                "Window", "Expand", "Location", "Child", "Format")) or s.startswith("+-")
                or s.startswith(":")):
            keep.append(line)
    return "\n".join(keep)


def main() -> None:
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    out = ["# Physical plans of the headline queries", "",
           f"`explain(\"formatted\")` at `{base}`, operator trees and scans only "
           "(regenerate with `python tools/explain_plans.py`). AQE may re-plan joins "
           "at run time from real sizes.", ""]
    for name in HEADLINE:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            REGISTRY[name](spark, base).explain("formatted")
        out += [f"## {name}", ""]
        if name in NOTES:
            out += [f"_{NOTES[name]}_", ""]
        out += ["```", tree(buf.getvalue()), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                        "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
