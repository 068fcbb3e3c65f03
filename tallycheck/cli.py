"""Command line for spark-submit: ``python -m tallycheck {ingest,dq,report} ...``.

* ``ingest``: landed attempt files -> Bronze append (one run id).
* ``dq``:     checks on a Bronze table -> audit append -> gate (exit 2 on FAIL).
* ``report``: rows of the latest run from the audit table.
"""

from __future__ import annotations

import argparse
import sys

from tallycheck import constants as K
from tallycheck.operators.gate import GateError
from tallycheck.operators.report import latest_run
from tallycheck.plans import DQConfig, run_bronze_dq, run_ingest
from tallycheck.session import build_session
from tallycheck.sources.audit import read_audit, read_latest_day
from tallycheck.sources.responses import read_responses


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallycheck")
    p.add_argument("--master", default=None, help="Spark master (leave unset under spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    i = sub.add_parser("ingest", help="append landed attempts to Bronze")
    i.add_argument("--landed", required=True, help="folder of landed attempt files")
    i.add_argument("--format", default="json", choices=["json", "parquet"])
    i.add_argument("--bronze-table", required=True)
    i.add_argument("--run-id", required=True)
    i.add_argument("--partition-by", action="append", default=[])
    i.add_argument("--replace-existing", action="store_true",
                   help="make these the run's only rows (Bronze partitioned by _ingestion_job_run_id)")
    i.add_argument("--quarantine-table", default=None, help="table for items that do not fit the schema")

    d = sub.add_parser("dq", help="run the Bronze checks, record them, apply the gate")
    d.add_argument("--bronze-table", required=True)
    d.add_argument("--audit-table", required=True)
    d.add_argument("--audit-by-day", action="store_true", help="partition a new audit table by run day")
    src = d.add_mutually_exclusive_group()
    src.add_argument("--title", action="append", help="an expected title; repeat it (default: the built-in list)")
    src.add_argument("--titles-table", help="table whose first column holds the titles")
    d.add_argument("--start", default=K.DEFAULT_START)
    d.add_argument("--end", default=K.DEFAULT_END)
    d.add_argument("--fail-on", action="append", default=[],
                   choices=[K.CHECK_COVERAGE, K.CHECK_DUPLICATES, K.CHECK_SCHEMA],
                   help="make this check a hard FAIL when it finds problems")
    d.add_argument("--run-id", default=None)
    d.add_argument("--failing-table", default=None, help="table for every missing or repeated key of the run")

    r = sub.add_parser("report", help="show the latest run of the audit table")
    r.add_argument("--audit-table", required=True)
    r.add_argument("--by", default="checked_at", choices=["checked_at", "check_run_id"])
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)

    if args.command == "ingest":
        run_ingest(
            read_responses(spark, args.landed, args.format),
            args.bronze_table,
            args.run_id,
            quarantine_table=args.quarantine_table,
            partition_by=tuple(args.partition_by),
            if_run_exists="replace" if args.replace_existing else "append",
        )
        print(f"wrote run {args.run_id} -> {args.bronze_table}")
        return 0

    if args.command == "dq":
        if args.titles_table:
            titles = spark.table(args.titles_table)
        elif args.title:
            titles = args.title
        else:
            titles = K.DEFAULT_TITLES
        cfg = DQConfig(
            titles=titles,
            start_date=args.start,
            end_date=args.end,
            policy={name: K.FAIL for name in args.fail_on},
        )
        try:
            run_id = run_bronze_dq(spark, args.bronze_table, args.audit_table, cfg, run_id=args.run_id,
                                   failing_table=args.failing_table, audit_by_day=args.audit_by_day)
        except GateError as err:
            print(str(err), file=sys.stderr)
            return 2
        print(f"Bronze DQ run completed: {run_id}")
        return 0

    # report: every row of one run, streamed to the terminal
    read = read_latest_day if args.by == "checked_at" else read_audit
    report = latest_run(read(spark, args.audit_table), by=args.by)
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
