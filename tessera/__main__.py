"""Command line: list the keys, run one, or print its plan.

    python -m tessera list
    python -m tessera run KEY [--sf DIR] [--show N] [--master local[8]]   # no --master: the cluster's settings
    python -m tessera explain KEY [--sf DIR]

On a cluster, ship the package to the executors (``--py-files``); the session
then takes the cluster's settings, including ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import ORACLES, QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("key", choices=sorted(QUERIES))
        p.add_argument("--sf", default="/root/testdata/sf0.01")
        p.add_argument("--master", help="only for local runs; by default the cluster's settings hold")
        if name == "run":
            p.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)
    if args.cmd == "list":
        for k in sorted(QUERIES):
            print(f"{k:24s} {'oracle' if k in ORACLES else 'model'}")
        return 0
    local = (args.master or "").startswith("local")
    spark = build_session(master=args.master, shuffle_partitions=8 if local else None)
    df = QUERIES[args.key](spark, args.sf)
    if args.cmd == "explain":
        df.explain("formatted")
    else:
        df.show(args.show, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
