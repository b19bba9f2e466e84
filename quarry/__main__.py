"""Command line: list the reports, show one, or export its full result.

    python -m quarry list
    python -m quarry show best_month_per_supplier --sf /root/testdata/sf0.1 [-n 20]
    python -m quarry export best_month_per_supplier --sf DIR --out PATH [--format csv|parquet]
    python -m quarry explain best_month_per_supplier --sf DIR
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="quarry")
    ap.add_argument("command", choices=["list", "show", "export", "explain"])
    ap.add_argument("report", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01", help="directory of <table>.parquet")
    ap.add_argument("-n", type=int, default=20, help="rows to show")
    ap.add_argument("--out", help="export folder (every task writes its own part file)")
    ap.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: the platform's")
    args = ap.parse_args(argv)

    from quarry.plans import OPS, QUERIES

    if args.command == "list":
        for name in sorted(QUERIES):
            print(f"{name:40s} {' '.join(OPS[name])}")
        return 0
    if args.report not in QUERIES:
        ap.error(f"unknown report {args.report!r}; see `python -m quarry list`")

    from quarry.session import build_session
    from quarry.sources import write_csv, write_parquet

    spark = build_session(args.master)
    df = QUERIES[args.report](spark, args.sf)
    if args.command == "show":
        df.show(args.n, truncate=False)
    elif args.command == "explain":
        df.explain("formatted")
    else:
        if not args.out:
            ap.error("export needs --out")
        (write_csv if args.format == "csv" else write_parquet)(df, args.out)
        print(args.out)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
