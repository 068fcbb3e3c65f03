"""Command line: ingest -> dq -> report, in the test session."""

import json
import os
import uuid

from tallycheck.cli import main


def test_cli_round_trip(spark, scratch, capsys):
    landed = os.path.join(scratch, f"landed_{uuid.uuid4().hex[:8]}")
    os.makedirs(landed)
    body = json.dumps({"items": [{"project": "p", "article": "Minecraft", "granularity": "daily",
                                  "timestamp": f"202601{d:02d}00", "views": d} for d in (1, 2)]})
    with open(os.path.join(landed, "part.json"), "w") as fh:
        fh.write(json.dumps({"title": "Minecraft", "attempt_no": 1, "status_code": 200, "body": body}) + "\n")
    bronze, audit = f"cli_bronze_{uuid.uuid4().hex[:6]}", f"cli_audit_{uuid.uuid4().hex[:6]}"

    ingest = ["ingest", "--landed", landed, "--bronze-table", bronze, "--run-id", "r1", "--replace-existing"]
    assert main(ingest) == 0
    assert main(ingest) == 0
    assert "wrote run r1" in capsys.readouterr().out
    assert spark.table(bronze).count() == 2

    args = ["dq", "--bronze-table", bronze, "--audit-table", audit, "--title", "Minecraft", "--title", "A, with a comma",
            "--start", "20260101", "--end", "20260103"]
    failing = f"cli_failing_{uuid.uuid4().hex[:6]}"
    assert main(args + ["--run-id", "warn-run", "--failing-table", failing]) == 0
    missing = sorted(tuple(r) for r in spark.table(failing).select("article", "timestamp", "check_name").collect())
    assert missing == [("A, with a comma", f"202601{d:02d}00", "source_coverage") for d in (1, 2, 3)] + [
        ("Minecraft", "2026010300", "source_coverage")]
    assert main(args + ["--run-id", "fail-run", "--fail-on", "source_coverage"]) == 2
    err = capsys.readouterr().err
    assert "Bronze DQ check(s) failed: source_coverage (check_run_id=fail-run)" in err
    assert spark.table(audit).count() == 6

    assert main(["report", "--audit-table", audit, "--by", "check_run_id"]) == 0
    shown = capsys.readouterr().out
    assert "warn-run" in shown and "fail-run" not in shown


def test_cli_replace_existing(spark, scratch, capsys):
    landed = os.path.join(scratch, f"landed_{uuid.uuid4().hex[:8]}")
    os.makedirs(landed)

    def land(views):
        body = json.dumps({"items": [{"article": "Minecraft", "timestamp": "2026010100", "views": views}]})
        with open(os.path.join(landed, "part.json"), "w") as fh:
            fh.write(json.dumps({"title": "Minecraft", "attempt_no": 1, "status_code": 200, "body": body}) + "\n")

    bronze = f"cli_bronze_{uuid.uuid4().hex[:6]}"
    args = ["ingest", "--landed", landed, "--bronze-table", bronze, "--run-id", "r1", "--replace-existing"]
    land(1)
    assert main(args) == 0
    land(5)  # corrected landing, same run id
    assert main(args) == 0
    spark.catalog.refreshTable(bronze)
    assert [tuple(r) for r in spark.table(bronze).select("views", "_ingestion_job_run_id").collect()] == [(5, "r1")]


def test_report_prints_every_row(spark, capsys):
    audit = f"cli_audit_{uuid.uuid4().hex[:6]}"
    spark.range(50).selectExpr(
        "'r' as check_run_id", "'bronze' as layer", "'t' as table_name", "concat('check_', id) as check_name",
        "'PASS' as check_status", "'0' as expected_value", "'0' as actual_value", "'d' as details",
        "timestamp'2026-01-01' as checked_at",
    ).write.saveAsTable(audit)
    assert main(["report", "--audit-table", audit]) == 0
    out = capsys.readouterr().out
    assert all(f"check_{k}\t" in out for k in range(50))
