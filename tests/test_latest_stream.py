"""One response per request across micro-batches, restarts and replays."""

import json
import os
import shutil
import uuid

import pytest

from tallycheck.sources.bronze import RUN_COLUMN
from tallycheck.streaming.latest import compact, current_rows, start_latest_stream, superseded_table


def attempt(title, no, days, status=200, views=1):
    items = [{"project": "p", "article": title, "granularity": "daily", "timestamp": f"202601{d:02d}00", "views": views} for d in days]
    return {"title": title, "start_date": "20260101", "end_date": "20260131", "attempt_no": no, "status_code": status, "body": json.dumps({"items": items})}


@pytest.fixture
def stream(spark, scratch):
    base = os.path.join(scratch, f"latest_{uuid.uuid4().hex[:8]}")
    landing, table = os.path.join(base, "landing"), f"log_{uuid.uuid4().hex[:8]}"
    os.makedirs(landing)

    class Stream:
        checkpoint = os.path.join(base, "checkpoint")
        log, view = table, f"{table}_view"

        def land(self, name, records):
            with open(os.path.join(landing, name), "w") as out:
                out.writelines(json.dumps(r) + "\n" for r in records)

        def run(self, **kw):
            query = start_latest_stream(spark, landing, table, "s", view=self.view, checkpoint_location=self.checkpoint, **kw)
            query.awaitTermination(120)

        def rows(self):
            return sorted((r.article, r.timestamp, r.views, r[RUN_COLUMN]) for r in spark.table(self.view).collect())

    return Stream()


def test_later_success_replaces_the_earlier_one_after_a_restart(spark, stream):
    stream.land("a.json", [attempt("A", 1, [1, 2], views=10), attempt("A", 2, [1, 2], views=11), attempt("B", 1, [1], views=5), attempt("C", 1, [1], 500)])
    stream.run()
    assert stream.rows() == [("A", "2026010100", 11, "s-0"), ("A", "2026010200", 11, "s-0"), ("B", "2026010100", 5, "s-0")]
    # a second query on the same checkpoint: A succeeds again, with fewer days; an old attempt of B comes late; C succeeds at last
    stream.land("b.json", [attempt("A", 3, [2], views=12), attempt("B", 0, [1, 2], views=4), attempt("C", 2, [3], views=1), attempt("A", 4, [9], 503)])
    stream.run()
    want = [("A", "2026010200", 12, "s-1"), ("B", "2026010100", 5, "s-0"), ("C", "2026010300", 1, "s-1")]
    assert stream.rows() == want
    stream.land("c.json", [attempt("A", 3, [5], views=13), attempt("B", None, [7], views=3)])
    stream.run()
    want = [("A", "2026010500", 13, "s-2"), ("B", "2026010100", 5, "s-0"), ("C", "2026010300", 1, "s-1")]
    assert stream.rows() == want
    assert spark.table(stream.view).columns == current_rows(spark, stream.log).columns
    # compaction takes the replaced rows out of the log and changes nothing for readers
    assert spark.table(stream.log).count() > len(want)
    assert sorted(compact(spark, stream.log)) == ["s-0", "s-1"]
    spark.catalog.refreshTable(stream.log)
    assert spark.table(stream.log).count() == len(want) and stream.rows() == want
    assert compact(spark, stream.log) == []


def test_a_batch_that_is_replayed_leaves_the_same_rows(spark, stream):
    stream.land("a.json", [attempt("A", 1, [1]), attempt("B", 1, [1])])
    stream.run()
    stream.land("b.json", [attempt("A", 2, [1, 2], views=7)])
    stream.run()
    before, gone = stream.rows(), spark.table(superseded_table(stream.log)).count()
    # as if the second batch had been written and its commit lost
    commits = os.path.join(stream.checkpoint, "commits")
    for name in ("1", ".1.crc"):
        if os.path.exists(path := os.path.join(commits, name)):
            shutil.copy(path, f"{stream.checkpoint}-{name}")
            os.remove(path)
    stream.run()
    assert stream.rows() == before == [("A", "2026010100", 7, "s-1"), ("A", "2026010200", 7, "s-1"), ("B", "2026010100", 1, "s-0")]
    assert spark.table(superseded_table(stream.log)).count() == gone == 1


def test_many_attempts_of_one_request_in_many_batches(spark, stream):
    for k in range(3):
        stream.land(f"{k}.json", [attempt("hot", 100 * k + j, [1 + j % 3], views=100 * k + j) for j in range(100)] + [attempt(f"t{k}", 1, [1])])
        stream.run(max_files_per_trigger=1)
    assert [r for r in stream.rows() if r[0] == "hot"] == [("hot", "2026010100", 299, "s-2")]
    assert {r[0] for r in stream.rows()} == {"hot", "t0", "t1", "t2"}
