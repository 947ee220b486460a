"""Print the check tool's figures of queries as rows for the README: ``check_figures.py FILE ...`` (its --json files)."""

import json
import sys

for path in sys.argv[1:]:
    for line in open(path):
        found = json.loads(line)
        large = found.get("sizes", {}).get("check_l", {})
        gb = max(large.get("gb", 0), 0.01)
        figures = [f"{large.get('cpu_s', 0) / gb:.0f}", f"{large.get('disk_gb', 0):.2f} GB", f"{large.get('executor_mb', 0):.0f}, {large.get('driver_mb', 0):.0f}"]
        print(found["name"], "pass" if found["pass"] else "fail", *figures, *found.get("why", [])[:2], sep=" | ")
