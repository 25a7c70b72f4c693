"""Run jobs from the command line: ``spark-submit ... -m orderlake`` or ``python -m orderlake``.

    python -m orderlake ROOT                      snapshots to marts
    python -m orderlake ROOT --job log            only the change log (and so on per job)
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from . import contract
from .contract import Layout
from .plans import pipeline
from .session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderlake")
    parser.add_argument("root", help="folder of snapshots, log, tables and marts")
    parser.add_argument("--job", choices=("all", "log", "compact", "current", "calendar", "facts", "marts"), default="all")
    parser.add_argument("--bucket-rows", type=int, default=Layout.bucket_rows, help="rows of a bucket of the current and fact tables")
    parser.add_argument("--source-schema", default="source", help="schema directory below each snapshot date")
    parser.add_argument("--tables", type=lambda t: tuple(t.split(",")), default=tuple(contract.LOGGED))
    parser.add_argument("--snapshot-date", help="log this snapshot only (default: every one not logged yet)")
    parser.add_argument("--prev-date", help="compare --snapshot-date with this one instead of the one before it")
    parser.add_argument("--start", help="first calendar day")
    parser.add_argument("--end", help="last calendar day")
    parser.add_argument("--as-of", type=date.fromisoformat, help="reference day of the marts (default: last order)")
    parser.add_argument("--batch-min-order-date", type=date.fromisoformat, help="with --job marts: recompute from its month")
    parser.add_argument("--full", action="store_true", help="rebuild everything from the whole log")
    parser.add_argument("--outlier-threshold", type=float, default=contract.OUTLIER_REVENUE)
    parser.add_argument("--lookback-months", type=int, default=contract.LOOKBACK_MONTHS)
    parser.add_argument("--at-risk-days", type=int, default=contract.AT_RISK_DAYS)
    parser.add_argument("--dormant-days", type=int, default=contract.DORMANT_DAYS)
    parser.add_argument("--period-days", type=int, default=contract.PERIOD_DAYS)
    # launchers add arguments of their own
    return parser.parse_known_args(argv)[0]


def run(spark, options: argparse.Namespace):
    layout = Layout(options.root.rstrip("/"), options.source_schema, options.bucket_rows)
    thresholds = {n: getattr(options, n) for n in ("lookback_months", "at_risk_days", "dormant_days", "period_days")}
    if options.job == "log":
        if options.snapshot_date or options.prev_date:
            return pipeline.log_pair(spark, layout, options.snapshot_date, options.prev_date, options.tables)
        return pipeline.log_pending(spark, layout, [t for t in options.tables if t in contract.LOGGED])
    if options.job == "compact":
        return pipeline.compact_log(spark, layout, options.tables)
    if options.job == "current":
        return pipeline.refresh_current(spark, layout, options.tables)
    if options.job == "calendar":
        return pipeline.refresh_calendar(spark, layout, options.start, options.end)
    if options.job == "facts":
        return pipeline.refresh_facts(spark, layout, options.outlier_threshold)
    if options.job == "marts":
        batch_min = None if options.full else options.batch_min_order_date
        return pipeline.refresh_marts(spark, layout, options.as_of, batch_min, **thresholds)
    return pipeline.run_pipeline(
        spark, layout, options.as_of, options.full, options.outlier_threshold, options.start, options.end, **thresholds
    )


if __name__ == "__main__":
    session = build_session()
    print(json.dumps(run(session, arguments()), default=str))
    session.stop()
