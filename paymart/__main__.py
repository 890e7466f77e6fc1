"""Command line: ``python -m paymart <command> ...``.

  ingest  --users CSV --merchants CSV --transactions CSV --root ROOT   incremental raw load
  build   --raw-root ROOT [--full]        bring the published layers and marts of ROOT up to date
  build   --sf-dir DIR --out ROOT         publish everything from a folder of driver tables
  views   --root ROOT                     enter the reporting views in the catalog and open them
  export  --root ROOT --out DIR           write the eight report sets as CSV from the published tables

``--as-of`` (ISO time, default now) is the run's time: tenure is counted to it
and the updated-at columns hold it.  ``export`` ends with 1 if a set failed.

The session comes from ``SparkSession.builder.getOrCreate()`` so that
``spark-submit`` settings (master, memory, checkpoint folder) apply.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from paymart.session import prepare


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="paymart")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest")
    for t in ("users", "merchants", "transactions", "root"):
        s.add_argument(f"--{t}", required=True)
    s = sub.add_parser("build")
    source = s.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw-root")
    source.add_argument("--sf-dir")
    s.add_argument("--out")
    s.add_argument("--full", action="store_true")
    s = sub.add_parser("views")
    s.add_argument("--root", required=True)
    s = sub.add_parser("export")
    s.add_argument("--root", required=True)
    s.add_argument("--out", required=True)
    for s in sub.choices.values():
        s.add_argument("--as-of", type=dt.datetime.fromisoformat, default=None)
    return p


def main(argv=None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.cmd == "build" and args.sf_dir and not args.out:
        parser.error("--sf-dir needs --out")
    run_at = args.as_of or dt.datetime.now()
    spark = prepare(SparkSession.builder.appName(f"paymart-{args.cmd}").getOrCreate())
    if args.cmd == "ingest":
        from paymart.operators import ingest
        rep = ingest.ingest(spark, {"users": args.users, "merchants": args.merchants,
                                    "transactions": args.transactions}, args.root, as_of=run_at)
        print(json.dumps(rep.__dict__))
        return 0
    from paymart.plans.published import Published
    if args.cmd == "build":
        if args.raw_root:
            done = Published(spark, args.raw_root).update(run_at, full=args.full)
        else:
            from paymart.sources import driver_tables
            done = Published(spark, args.out).update_from(driver_tables.load_raw(spark, args.sf_dir), run_at)
        print(json.dumps(done))
        return 0
    published = Published(spark, args.root)
    if args.cmd == "views":
        print(json.dumps(published.deploy_views(run_at)))
        return 0
    from paymart.operators import export, reporting
    rep = {name: fn(published.table(mart)) for name, (mart, fn) in reporting.VIEWS.items()}
    sets = export.export_sets({n: published.table(n) for n in ("daily_overview_kpis", "dim_users",
                                                               "fraud_analysis_mart")}, rep)
    written = export.export_reports(sets, args.out)
    print(json.dumps(written))
    return 0 if set(written) == set(sets) else 1


if __name__ == "__main__":
    raise SystemExit(main())
