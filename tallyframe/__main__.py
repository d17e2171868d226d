"""Run catalogue queries from the command line.

    python -m tallyframe --list
    python -m tallyframe state_change_gap_percentiles --data /data/sf100 [--show 20]
    python -m tallyframe month_end_balance --data /data/sf100 --out /shared/out/meb --format parquet
    python -m tallyframe payment_schedule --data /data/sf1 --sql     # print the oracle SQL
"""

from __future__ import annotations

import argparse

from tallyframe.plans.catalogue import QUERIES, runner
from tallyframe.session import get_session


def main(argv=None):
    ap = argparse.ArgumentParser(prog="tallyframe")
    ap.add_argument("query", nargs="?")
    ap.add_argument("--list", action="store_true", help="list the registered queries")
    ap.add_argument("--data", help="folder holding <table>.parquet")
    ap.add_argument("--show", type=int, default=20, help="rows to print when no --out is given")
    ap.add_argument("--out", help="write the result here instead of printing it")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--sql", action="store_true", help="print the query's oracle SQL and exit")
    args = ap.parse_args(argv)
    if args.list or not args.query:
        for name, q in QUERIES.items():
            print(f"{name:42s} {q.doc.splitlines()[0] if q.doc else ''}")
        return
    if args.sql:
        print(QUERIES[args.query].oracle or "-- no SQL form")
        return
    spark = get_session()
    df = runner(args.query)(spark, args.data)
    if args.out:
        df.write.mode("overwrite").format(args.format).save(args.out)
    else:
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
