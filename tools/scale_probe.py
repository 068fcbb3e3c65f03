"""Scaling probe: the DQ run over a Bronze table k times the size of sf0.1 events.

Bronze is derived from ``events`` (every event repeated ``k`` times with a
shifted key), and one key is made to hold a third of all rows. It is written
as parquet into a scratch folder, then the three checks run into the
``noop`` sink. Prints one JSON line with rows, seconds and rows per second.

Usage: python tools/scale_probe.py [k=100] [sf_dir=/root/testdata/sf0.1] [dq|ingest]

``ingest`` instead lands the four-attempt pages of the ``events`` binding k
times (each copy a distinct request) as parquet and times the ingest plan
(classify, latest success, parse, explode, lineage) into the ``noop`` sink.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallycheck.plans import DQConfig, run_checks  # noqa: E402
from tallycheck.session import build_session  # noqa: E402
from tallycheck.sources import bindings as B  # noqa: E402
from tallycheck.sources.bronze import with_lineage  # noqa: E402


def ingest_probe(spark, k: int, sf_dir: str, scratch: str) -> None:
    from tallycheck.plans import ingest

    events = B.read_table(spark, sf_dir, "events")
    landed = B.landed_attempts(events)
    copies = landed.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("copy")).select(
        F.concat(F.col("title"), F.lit("_"), F.col("copy").cast("string")).alias("title"),
        "start_date", "end_date", "page", "attempt_no", "status_code", "body", "error",
    )
    path = os.path.join(scratch, "landed")
    t0 = time.perf_counter()
    copies.repartition(32).write.parquet(path)
    t_write = time.perf_counter() - t0
    attempts = spark.read.parquet(path)
    n_attempts = attempts.count()
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        ingest(attempts, "scale", dt.datetime(2026, 1, 31)).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    best = min(times)
    items = events.count() * k
    print(json.dumps({
        "k": k, "landed_attempts": n_attempts, "items_out": items, "write_sec": round(t_write, 2),
        "ingest_sec": round(best, 2), "items_per_sec": int(items / best),
    }))


def main() -> None:
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    mode = sys.argv[3] if len(sys.argv) > 3 else "dq"
    scratch = tempfile.mkdtemp(prefix="tallycheck-scale-", dir="/tmp")
    spark = build_session("local[8]", shuffle_partitions=64)
    spark.sparkContext.setLogLevel("ERROR")
    if mode == "ingest":
        ingest_probe(spark, k, sf_dir, scratch)
        spark.stop()
        return

    events = B.read_table(spark, sf_dir, "events")
    recs = B.records_from_events(events, carry=("event_id",))
    copies = recs.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("copy"))
    hot = (F.col("event_id") + F.col("copy")) % 3 == 0
    bronze_rows = copies.select(
        "project",
        F.when(hot, F.lit("user_hot")).otherwise(
            F.concat(F.col("article"), F.lit("_"), (F.col("copy") % 10).cast("string"))
        ).alias("article"),
        "granularity",
        F.when(hot, F.lit("2024010100")).otherwise(F.col("timestamp")).alias("timestamp"),
        "views",
    )
    path = os.path.join(scratch, "bronze")
    t0 = time.perf_counter()
    with_lineage(bronze_rows, "scale", dt.datetime(2026, 1, 31)).repartition(32).write.parquet(path)
    t_write = time.perf_counter() - t0

    bronze = spark.read.parquet(path)
    n = bronze.count()
    titles = [f"user_{u}_{c}" for u in range(0, 1500, 7) for c in range(10)] + ["user_hot"]
    cfg = DQConfig(titles=titles, start_date=B.BINDING_START, end_date=B.BINDING_END)
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        rows = run_checks(spark, bronze, "bronze", "r", dt.datetime(2026, 1, 31), cfg).collect()
        times.append(time.perf_counter() - t0)
    best = min(times)
    print(json.dumps({
        "k": k, "bronze_rows": n, "write_sec": round(t_write, 2), "dq_sec": round(best, 2),
        "rows_per_sec": int(n / best),
        "results": {r["check_name"]: [r["check_status"], r["expected_value"], r["actual_value"]] for r in rows},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
