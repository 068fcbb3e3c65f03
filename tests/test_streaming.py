"""Streaming ingest of landed attempt files."""

import json
import os
import uuid

from pyspark.sql import functions as F

from tallycheck.streaming import start_ingest_stream


def _write_lines(path, records):
    with open(path, "w") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


def _attempt(title, no, status, days):
    body = json.dumps({"items": [{"project": "p", "article": title, "granularity": "daily",
                                  "timestamp": f"202601{d:02d}00", "views": d} for d in days]})
    return {"title": title, "start_date": "20260101", "end_date": "20260131", "attempt_no": no,
            "status_code": status, "body": body if status == 200 else None}


def test_stream_appends_each_batch_once(spark, scratch):
    base = os.path.join(scratch, f"stream_{uuid.uuid4().hex[:8]}")
    landing = os.path.join(base, "landing")
    os.makedirs(landing)
    table = f"bronze_stream_{uuid.uuid4().hex[:8]}"
    _write_lines(os.path.join(landing, "a.json"),
                 [_attempt("Minecraft", 1, 500, []), _attempt("Minecraft", 2, 200, [1, 2])])

    q = start_ingest_stream(spark, landing, table, "s")
    q.awaitTermination(120)
    first = spark.table(table)
    assert first.count() == 2
    assert {r[0] for r in first.select("_ingestion_job_run_id").distinct().collect()} == {"s-0"}

    # new file lands; restart from the same checkpoint picks up only the new one
    _write_lines(os.path.join(landing, "b.json"), [_attempt("Cyberpunk_2077", 1, 200, [1, 2, 3])])
    q = start_ingest_stream(spark, landing, table, "s")
    q.awaitTermination(120)
    out = spark.table(table)
    assert out.count() == 5
    per_run = {r[0]: r[1] for r in out.groupBy("_ingestion_job_run_id").count().collect()}
    assert per_run == {"s-0": 2, "s-1": 3}
    assert out.filter(F.col("article") == "Cyberpunk_2077").count() == 3

    # the checkpoint went under the session's checkpoint folder
    cp = spark.sparkContext.getCheckpointDir()
    assert cp and os.path.isdir(cp.replace("file:", ""))
