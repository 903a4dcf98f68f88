"""Print the condensed physical plan (operators and exchanges) of registered queries.

Usage: python tools/show_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        m = re.match(r"^([\s:+\-|]*)(\*?\(?\d*\)?\s*)(\w+)(.*)$", line)
        if not m:
            continue
        prefix, _, op, rest = m.groups()
        detail = ""
        if op == "Exchange":
            detail = " " + rest.strip().split(",")[0].replace("hashpartitioning(", "hash(") + ")"
        elif op in ("BroadcastHashJoin", "SortMergeJoin"):
            detail = " " + " ".join(w for w in rest.split() if w in ("Inner", "BuildLeft", "BuildRight"))
        elif op == "FileScan":
            detail = " " + rest.strip().split(" ")[0] + " " + (re.search(r"ReadSchema: (struct<[^>]*>)", rest) or
                                                                  re.search(r"()", "")).group(1)
        elif op == "Generate":
            detail = " " + rest.strip().split("(")[0]
        out.append(f"{prefix}{op}{detail}")
    return "\n".join(out)


def main():
    from gridspark.plans import catalog as C
    from gridspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["ingest", "ingest_files", "grid_unpivot", "grid_file_scan", "notify_param_join",
                             "grid_count", "grid_preview"]
    spark = local_session(8)
    for name in names:
        print(f"### {name}\n```\n{condensed(C.QUERIES[name](spark, sf))}\n```\n")


if __name__ == "__main__":
    main()
