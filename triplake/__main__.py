"""Command line: run the layers one at a time or end to end.

    python -m triplake bronze  --raw DIR --lake ROOT [--no-reconcile]
    python -m triplake silver  --lake ROOT [--last-month YYYY-MM] [--cluster]
    python -m triplake gold    --lake ROOT [--keep-null-zone]
    python -m triplake run     --raw DIR --lake ROOT [--last-month YYYY-MM] [--no-reconcile] [--resume]
    python -m triplake ingest  --raw DIR --lake ROOT [--no-reconcile]   (only unseen files)
    python -m triplake report  --lake ROOT [--raw DIR] [--last-month YYYY-MM] [--min-year 2019]
    python -m triplake audit   --lake ROOT --start-year 2019 [--as-of YYYY-MM-DD]

Steps find each other's tables in the session's catalog: separate processes
need a persistent one.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from triplake.config import GoldOptions, Lake, QualityRules
from triplake.contracts import RAW_FILE_GLOB


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="triplake")
    ap.add_argument("step", choices=["bronze", "silver", "gold", "run", "ingest", "report", "audit"])
    ap.add_argument("--raw", help="folder of raw trip files")
    ap.add_argument("--lake", required=True, help="lake root (path or URI)")
    ap.add_argument("--glob", default=RAW_FILE_GLOB)
    ap.add_argument("--reconcile", action=argparse.BooleanOptionalAction, default=True,
                    help="files may differ in physical schema (default)")
    ap.add_argument("--duration-scale", type=int, default=None, help="decimals of silver's duration")
    ap.add_argument("--resume", action="store_true", help="run: take new files only, skip what is up to date")
    ap.add_argument("--rescue", action="store_true", help="keep malformed values aside instead of failing")
    ap.add_argument("--catalog", default=None, help="name of the lake in the catalog (default: made from its root)")
    ap.add_argument("--last-month", default=None, help="YYYY-MM upper pickup bound (inclusive)")
    ap.add_argument("--min-year", type=int, default=2019)
    ap.add_argument("--max-amount", type=float, default=1000.0)
    ap.add_argument("--max-minutes", type=float, default=720.0)
    ap.add_argument("--max-distance", type=float, default=200.0)
    ap.add_argument("--cluster", action="store_true", help="range-cluster silver before writing")
    ap.add_argument("--keep-null-zone", action="store_true")
    ap.add_argument("--start-year", type=int, default=2019)
    ap.add_argument("--as-of", default=None, help="YYYY-MM-DD for the month coverage audit")
    ap.add_argument("--top", type=int, default=15)
    ap.add_argument("--pre-period-end-year", type=int, default=2020,
                    help="months before this year form the pre-period of the recovery figures")
    return ap


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from triplake.operators import audit
    from triplake.plans import pipeline
    from triplake.plans.inspect import fetch
    from triplake.session import get_spark, scratch_scope

    spark = get_spark()
    lake = Lake(args.lake, catalog=args.catalog)
    rules = QualityRules(
        max_minutes=args.max_minutes,
        max_distance=args.max_distance,
        max_amount=args.max_amount,
        min_year=args.min_year,
        last_month=args.last_month,
    )
    opts = GoldOptions(drop_null_zone=not args.keep_null_zone, duration_scale=args.duration_scale)
    out: dict = {}
    if args.step in ("bronze", "ingest", "run") and not args.raw:
        raise SystemExit("--raw is required for this step")
    with scratch_scope(spark):
        if args.step == "bronze":
            out["bronze_rows"] = pipeline.write_bronze(spark, args.raw, lake, args.reconcile, args.glob,
                                                       rescue=args.rescue)
        elif args.step == "silver":
            out["silver_rows"] = pipeline.write_silver(spark, lake, rules, args.duration_scale, args.cluster)
        elif args.step == "gold":
            out["gold_rows"], out["failed"], _ = pipeline.write_gold(spark, lake, opts)
        elif args.step == "run":
            r = pipeline.run_pipeline(spark, args.raw, lake, rules, opts, args.reconcile, args.glob,
                                      raise_on_failure=False, cluster_silver=args.cluster,
                                      duration_scale=args.duration_scale, resume=args.resume, rescue=args.rescue)
            out = {"bronze_rows": r.bronze_rows, "silver_rows": r.silver_rows, "removed_rows": r.removed_rows,
                   "gold_rows": r.gold_rows, "failed": r.failed, "skipped": r.skipped}
        elif args.step == "ingest":
            from triplake.streaming.incremental import ingest

            added = ingest(spark, args.raw, lake, lake.checkpoint("bronze_ingest"), args.reconcile, glob=args.glob,
                           rescue=args.rescue)
            out["added"] = {"files": added.files, "rows": added.rows, "skipped": added.skipped, "lost": added.lost}
        elif args.step == "report":
            from triplake.plans.report import fetch_report, report_frames

            out.update(fetch_report(report_frames(spark, lake, args.min_year, args.last_month, args.top,
                                                  args.pre_period_end_year, args.raw, args.glob)))
        elif args.step == "audit":
            bronze = pipeline.read_layer(spark, lake, "bronze")
            as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
            out["validation"] = fetch(audit.load_validation(bronze)).to_dict("records")
            out["missing_months"] = fetch(audit.missing_months(bronze, args.start_year, as_of)).to_dict("records")
    print(json.dumps(out, default=str, ensure_ascii=False))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
