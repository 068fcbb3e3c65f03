"""One response per request over a whole stream: a later success replaces an earlier one, across micro-batches and restarts.

Spark's state store keeps, per request, the number of the best attempt so far and the batch that holds it, never a body. A batch
hands on only the successes that beat it (a greater attempt number; of equal ones the later batch), with the batch they replace. They
are appended to a log table, partitioned by batch run, whose rows carry their request's key; the replaced (request, run) pairs go to a small table beside it.
A view over both, with Bronze's own columns, leaves replaced rows out, so readers and the DQ run see each request once.
:func:`compact` takes replaced rows out of the log itself, rewriting only the runs that hold some.

Both writes replace the run's own partition, so a batch that is replayed after a failure or a restart leaves the same rows. State and batch
ids live in the stream's checkpoint; a fresh checkpoint needs a fresh run prefix. Successes of one request within a batch are thinned out on the map side before
the keyed shuffle, so a request with a third of all attempts reaches its task as a few rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallycheck.operators.fetch import REQUEST_KEYS, is_fetched
from tallycheck.operators.flatten import flatten_responses
from tallycheck.schemas import BRONZE_SCHEMA, RESPONSE_SCHEMA
from tallycheck.session import checkpoint_dir
from tallycheck.sources.bronze import RUN_COLUMN, with_lineage, write_by_run
from tallycheck.streaming.ingest_stream import landed_stream

#: The request of a row of the log: a hash of its key columns, as text.
REQUEST_COLUMN = "_request"
#: Below every attempt number: what a NULL one counts as.
_NO_ATTEMPT = -(1 << 63)
_BATCH_PROPERTY = "streaming.sql.batchId"
_WON = "request string, attempt_no long, body string, replaces long"


def request_id(keys: Sequence[str]) -> F.Column:
    """SHA-256 over the key columns, NULLs told apart from texts."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("n")) for k in keys]
    return F.sha2(F.concat_ws("|", *parts), 256)


def _better(best: tuple | None, attempt: int, body: str) -> bool:
    return best is None or (attempt, body) > best


def _thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The best success per request of each batch of rows."""
    for frame in frames:
        ranked = frame.sort_values(["attempt_no", "body"], kind="stable")
        yield ranked.drop_duplicates("request", keep="last")


def _winner(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The best success of this batch, if it beats what earlier batches had."""
    best: tuple | None = None
    for frame in frames:
        for attempt, body in zip(frame["attempt_no"], frame["body"]):
            if _better(best, int(attempt), body):
                best = (int(attempt), body)
    known, holder = state.get if state.exists else (None, None)
    if best is None or (known is not None and best[0] < known):
        return
    batch = int(TaskContext.get().getLocalProperty(_BATCH_PROPERTY))
    state.update((best[0], batch))
    yield pd.DataFrame({"request": [key[0]], "attempt_no": [best[0]], "body": [best[1]], "replaces": pd.array([holder], dtype="Int64")})


def winners(attempts: DataFrame, keys: Sequence[str] = REQUEST_KEYS) -> DataFrame:
    """Stream of (request, attempt_no, body, replaces) from a stream of attempts; ``replaces``: the batch that held the request before, or NULL.

    State grows by one small row per request ever seen.
    """
    number = F.coalesce(F.col("attempt_no"), F.lit(_NO_ATTEMPT))
    ok = attempts.filter(is_fetched()).select(request_id(keys).alias("request"), number.alias("attempt_no"), "body")
    thin = ok.mapInPandas(_thin, "request string, attempt_no long, body string")
    return thin.groupBy("request").applyInPandasWithState(_winner, _WON, "attempt_no long, batch long", "append", GroupStateTimeout.NoTimeout)


def superseded_table(log_table: str) -> str:
    return f"{log_table}_replaced"


def current_rows(spark: SparkSession, log_table: str) -> DataFrame:
    """The log's rows but replaced ones, with Bronze's columns."""
    return spark.sql(_current_sql(log_table))


def _current_sql(log_table: str) -> str:
    columns = ", ".join(f"l.`{f.name}`" for f in BRONZE_SCHEMA.fields)
    gone = superseded_table(log_table)
    return (
        f"SELECT {columns} FROM {log_table} l LEFT ANTI JOIN {gone} r "
        f"ON l.`{REQUEST_COLUMN}` = r.`{REQUEST_COLUMN}` AND l.`{RUN_COLUMN}` = r.replaced_run"
    )


def create_view(spark: SparkSession, log_table: str, view: str) -> None:
    """``view``: the log as readers should see it. Holds for all later batches."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {_current_sql(log_table)}")


def write_batch(won: DataFrame, batch_id: int, log_table: str, run_prefix: str, ingested_at: dt.datetime) -> None:
    """Append a batch's winners to the log and what they replace to the table beside it, each by its run."""
    run_id = f"{run_prefix}-{batch_id}"
    items = flatten_responses(won.select("request", "body"), keep=("request",)).withColumnRenamed("request", REQUEST_COLUMN)
    rows = with_lineage(items, run_id, ingested_at, keep=(REQUEST_COLUMN,))
    # replaced rows first: a reader between the writes misses a request for a moment but never sees two
    gone = won.filter("replaces is not null").select(
        F.col("request").alias(REQUEST_COLUMN), F.concat(F.lit(f"{run_prefix}-"), F.col("replaces").cast("string")).alias("replaced_run"), F.lit(run_id).alias(RUN_COLUMN)
    )
    write_by_run(gone, superseded_table(log_table), run_id)
    write_by_run(rows, log_table, run_id)


def start_latest_stream(
    spark: SparkSession,
    landing_path: str,
    log_table: str,
    run_prefix: str,
    view: str | None = None,
    fmt: str = "json",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    keys: Sequence[str] = REQUEST_KEYS,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``available_now`` drains what has landed and stops. ``view`` is made after the first batch."""
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{log_table.replace('.', '_')}"
    present = [k for k in keys if k in RESPONSE_SCHEMA.fieldNames()]

    def batch(won: DataFrame, batch_id: int) -> None:
        # the winners serve two writes; they are materialised once, so that the state is read and written once
        won = won.persist()
        try:
            write_batch(won, batch_id, log_table, run_prefix, dt.datetime.now(dt.timezone.utc))
        finally:
            won.unpersist()
        for table in (log_table, superseded_table(log_table)):
            spark.catalog.refreshTable(table)
        if view:
            create_view(spark, log_table, view)

    writer = (
        winners(landed_stream(spark, landing_path, fmt, max_files_per_trigger), present)
        .writeStream.foreachBatch(batch)
        .outputMode("append")
        .option("checkpointLocation", location)
        .queryName(f"latest_{log_table.replace('.', '_')}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def compact(spark: SparkSession, log_table: str) -> list[str]:
    """Take replaced rows out of the log, rewriting only the runs that hold some; returns those runs.

    The pairs stay, so a run that is rewritten twice, or a compaction that stops midway, does no harm.
    """
    gone = spark.table(superseded_table(log_table))
    log = spark.table(log_table)
    held = log.select(REQUEST_COLUMN, F.col(RUN_COLUMN).alias("replaced_run")).join(gone.select(REQUEST_COLUMN, "replaced_run"), [REQUEST_COLUMN, "replaced_run"], "left_semi")
    runs = [r[0] for r in held.select("replaced_run").distinct().toLocalIterator()]  # run ids, not rows
    for run in runs:
        of_run = gone.filter(F.col("replaced_run") == run).select(REQUEST_COLUMN)
        kept = log.filter(F.col(RUN_COLUMN) == run).join(of_run, REQUEST_COLUMN, "left_anti").select(*log.columns)
        path = f"{checkpoint_dir(spark).rstrip('/')}/compact/{log_table}/{run}"
        kept.write.mode("overwrite").parquet(path)  # a table cannot be overwritten by what is read from it
        write_by_run(spark.read.schema(log.schema).parquet(path), log_table, run)
        spark.catalog.refreshTable(log_table)
    return runs
