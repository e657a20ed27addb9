"""Print the SURVEY-ID -> registered queries map as a Markdown table."""

import os
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickvault.plans import catalog  # noqa: E402,F401
from tickvault.plans.registry import REGISTRY  # noqa: E402


def key(op):
    m = re.match(r"([A-Z]+)(\d+)(b?)", op)
    return (m.group(1), int(m.group(2)), m.group(3)) if m else (op, 0, "")


def main():
    by_op = defaultdict(list)
    for name, e in REGISTRY.items():
        for op in e.ops.split():
            by_op[op].append(name + ("" if e.oracle else " (rows-only)"))
    print("| SURVEY id | registered queries |")
    print("| --- | --- |")
    for op in sorted(by_op, key=key):
        print(f"| {op} | {', '.join(sorted(by_op[op]))} |")
    print(f"\n{len(REGISTRY)} queries, {sum(1 for e in REGISTRY.values() if e.oracle)} with a DuckDB oracle.")


if __name__ == "__main__":
    main()
