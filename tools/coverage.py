"""Print the SURVEY section 2 operator IDs with the reports that exercise them (markdown).

Fails when an ID that is meant to be covered has no report, or when a library
function is called by no report and no other module.
"""

from __future__ import annotations

import os
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FAMILIES = {"S": 6, "P": 8, "F": 15, "J": 16, "Q": 5, "A": 23, "W": 4, "O": 7, "X": 18, "D": 14}


def unused_functions() -> list[str]:
    """Names that quarry.operators, functions and sources export and no module uses."""
    import quarry.functions
    import quarry.operators
    import quarry.sources
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "quarry")
    text = ""
    for folder, _, files in os.walk(root):
        for f in files:
            if f.endswith(".py") and f != "__init__.py" and "llm" not in folder:
                with open(os.path.join(folder, f), encoding="utf-8") as fh:
                    text += fh.read()
    names = [n for m in (quarry.functions, quarry.operators, quarry.sources) for n in m.__all__]
    # Once is the definition itself.
    return [n for n in names if len(re.findall(rf"\b{n}\b", text)) < 2]


def main():
    from quarry.plans import OPS
    by_op = defaultdict(list)
    for name, ops in OPS.items():
        for op in ops:
            by_op[op].append(name)
    for fam, n in FAMILIES.items():
        for i in range(1, n + 1):
            op = f"{fam}{i}"
            names = sorted(by_op.get(op, []))
            print(f"| {op} | {', '.join(f'`{x}`' for x in names) if names else '-'} |")
    refused = {"J8"}  # the Cartesian product
    missing = [f"{f}{i}" for f, n in FAMILIES.items() for i in range(1, n + 1)
               if f"{f}{i}" not in by_op and f"{f}{i}" not in refused]
    unused = unused_functions()
    if missing or unused:
        print("without a report:", missing, "never called:", unused)
        sys.exit(1)
    unknown = [op for op in by_op if not re.fullmatch(r"[A-Z]\d+", op)]
    if unknown:
        print("unknown ids:", unknown)


if __name__ == "__main__":
    main()
