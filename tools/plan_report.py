"""Physical-plan summary of the headline queries (``explain("formatted")`` digested).

    python tools/plan_report.py [sf_dir] [name ...]  > PLANS.md

Counts exchanges, broadcasts, join kinds, windows and generators per query and lists
what every parquet scan reads and pushes down.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from qoeflow.plans import catalog  # noqa: E402
from qoeflow.session import local_session  # noqa: E402

HEADLINE = ["base_table", "kpi_time_to_top", "kpi_pct_below_top", "session_ptbtp", "score_session",
            "score_device", "score_account", "wifi_session_hour"]
NODES = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
         "HashAggregate", "ObjectHashAggregate", "Window", "Generate", "Scan parquet", "Scan ExistingRDD"]


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or HEADLINE
    spark = local_session(8, 16)
    reg = catalog.registry()
    print(f"# Physical plans at {sf_dir} (before AQE re-planning)\n")
    print("| query | " + " | ".join(NODES) + " |")
    print("| --- |" + " --- |" * len(NODES))
    scans = {}
    for name in names:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            reg[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        heads = re.findall(r"^\(\d+\) ([A-Za-z ]+?)(?: \[| \(|$| [A-Z][a-z]+ \(|\s*$)", text, flags=re.M)
        c = Counter(h.strip() for h in heads)
        print(f"| {name} | " + " | ".join(str(c.get(n, 0)) for n in NODES) + " |")
        scans[name] = re.findall(r"^\(\d+\) Scan parquet.*?\nOutput.*?\n(?:.*\n)*?ReadSchema: (.*)", text, flags=re.M)
        pushed = re.findall(r"^PushedFilters: (.*)$", text, flags=re.M)
        scans[name] = list(zip(pushed, re.findall(r"^ReadSchema: (.*)$", text, flags=re.M)))
    print("\n## Parquet scans (pushed filters, read schema)\n")
    for name, items in scans.items():
        print(f"* **{name}**")
        for pushed, schema in sorted(set(items)):
            print(f"  * `{pushed}` → `{schema}`")
    spark.stop()


if __name__ == "__main__":
    main()
