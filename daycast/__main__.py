"""Command line for spark-submit / python -m daycast.

    python -m daycast list
    python -m daycast query KEY --sf-dir DIR --out PATH [--cluster]
    python -m daycast run --sf-dir DIR --root DIR --as-of 2026-01-01T00:00:00 [--trials 50] [--cluster]
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="daycast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered query keys")
    q = sub.add_parser("query", help="run one registered query and write its result as Parquet")
    q.add_argument("key")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    q.add_argument("--cluster", action="store_true")
    r = sub.add_parser("run", help="the full pipeline into an artifact root")
    r.add_argument("--sf-dir", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--as-of", required=True)
    r.add_argument("--trials", type=int, default=50)
    r.add_argument("--cluster", action="store_true")
    a = ap.parse_args(argv)

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from daycast.plans.catalog import QUERIES

    if a.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    from daycast.session import get_session

    spark = get_session(cluster=a.cluster)
    if a.cmd == "query":
        QUERIES[a.key](spark, a.sf_dir).write.mode("overwrite").parquet(a.out)
        return 0
    from daycast.plans.run import run_pipeline

    out = run_pipeline(spark, a.sf_dir, a.root, a.as_of, n_trials=a.trials)
    out["metrics"].show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
