"""Continuous ingest, history, mart, checks and alerts.

A micro-batch writes loads named by the stream's own id, which lives in its checkpoint, and the batch number.
A stream with a new checkpoint is a new stream: its batches do not meet those of an earlier one.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millwatch import settings as S
from millwatch.operators.history import rename_cast
from millwatch.plans import build as B
from millwatch.sources.landing import good_rows, parse_landing, stream_landing_csv, with_provenance
from millwatch.sources.tables import Store

MERGE_EVERY = 64  # micro-batches
FILES_PER_BATCH = 1000  # so that the first ingest of a backlog is not one batch; no bound on times there


def auto_ingest(
    store: Store,
    path: str,
    checkpoint: str,
    sep: str = ",",
    trigger: dict | None = None,
    max_files_per_trigger: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Append each new landing file once to the landing table, and its bad rows to the rejects."""

    def on_batch(raw: DataFrame, load: str, batch: int) -> None:
        B.land(store, parse_landing(raw, sep), load)
        _tidy(store, [B.LANDING, B.REJECTS], load, batch)

    return _start(store, path, checkpoint, sep, trigger, on_batch, max_files_per_trigger)


def stream_build(
    store: Store,
    path: str,
    checkpoint: str,
    sep: str = ",",
    trigger: dict | None = None,
    with_alerts: bool = False,
    now: Column | None = None,
    max_files_per_trigger: int | None = None,
    alert_parts: int = 1,
) -> StreamingQuery:
    """Land new files and bring history, mart, check results and alerts up to date in the same micro-batch.

    Late data: what is not later than everything stored before the micro-batch is dropped, while order
    within it does not matter. A watermark cannot say this, since it lags one micro-batch behind. So all files
    at hand are one micro-batch, else the first files of a backlog would make the others late; a caller that sets
    `max_files_per_trigger` says that files come in the order of their times.

    With `with_alerts` every micro-batch ends in an alert pass; do not run `alert_schedule` on the same
    store then, as the alerts table has one writer.
    """

    def on_batch(raw: DataFrame, load: str, batch: int) -> None:
        B.land(store, parse_landing(raw, sep), load)
        # Read back what was landed: a retry sees the same rows.
        B.build(store, store.load(B.LANDING, load), load)
        if with_alerts:
            B.alert_pass(store, load, batch, now, alert_parts)
        if batch % MERGE_EVERY == MERGE_EVERY - 1:
            B.fold_totals(store, load)
        _tidy(store, [B.LANDING, B.REJECTS, B.HISTORY, *([B.ALERTS] if with_alerts else [])], load, batch)

    return _start(store, path, checkpoint, sep, trigger, on_batch, max_files_per_trigger)


def dedup_stream(
    store: Store,
    path: str,
    checkpoint: str,
    delay: str = S.WATERMARK_DELAY,
    sep: str = ",",
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append each new reading once to the deduplicated table, with keys kept in Spark's state store.

    The looser form of `stream_build`: a reading is late only if it is `delay` or more behind the latest time of earlier micro-batches,
    so slow machines may come after fast ones. A key is remembered for that long, and a repetition of it is dropped
    within a micro-batch and across them. Which of several rows with one key stays is not fixed. Readings without a
    time have no place in the order and are left out.
    """

    def on_batch(rows: DataFrame, load: str, batch: int) -> None:
        store.append(B.DEDUPLICATED, rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")), load)
        _tidy(store, [B.DEDUPLICATED], load, batch)

    raw = with_provenance(stream_landing_csv(store.spark, path, sep, max_files_per_trigger=max_files_per_trigger))
    timed = rename_cast(good_rows(parse_landing(raw, sep))).withColumn("event_time", F.col("event_time").cast("timestamp"))
    kept = timed.where("event_time IS NOT NULL").withWatermark("event_time", delay).dropDuplicatesWithinWatermark(S.HISTORY_KEY)
    return _run(kept, checkpoint, trigger, on_batch)


def _tidy(store: Store, names: list[str], load: str, batch: int) -> None:
    if batch % MERGE_EVERY == MERGE_EVERY - 1:
        for name in names:
            store.merge_loads(name, load, MERGE_EVERY)


def _start(
    store: Store,
    path: str,
    checkpoint: str,
    sep: str,
    trigger: dict | None,
    on_batch: Callable[[DataFrame, str, int], None],
    max_files: int | None,
) -> StreamingQuery:
    raw = with_provenance(stream_landing_csv(store.spark, path, sep, max_files_per_trigger=max_files))
    return _run(raw, checkpoint, trigger, on_batch)


def _run(
    rows: DataFrame, checkpoint: str, trigger: dict | None, on_batch: Callable[[DataFrame, str, int], None]
) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(lambda df, batch: on_batch(df, load_name(df, checkpoint, batch), batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": S.FILE_POLL_INTERVAL}))
        .start()
    )


def load_name(df: DataFrame, checkpoint: str, batch: int) -> str:
    """The stream's id, which Spark keeps in the checkpoint, and the number of the micro-batch."""
    stream = df.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
    return f"{stream}-{batch:012d}"


def alert_schedule(
    store: Store, checkpoint: str, every: str = S.ALERT_INTERVAL, now: Column | None = None, parts: int = 1
) -> StreamingQuery:
    """Evaluate the mart at a fixed interval. The rate source is only the clock."""

    def on_tick(_: DataFrame, load: str, batch: int) -> None:
        B.alert_pass(store, load, batch, now, parts)
        _tidy(store, [B.ALERTS], load, batch)

    clock = store.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return _run(clock, checkpoint, {"processingTime": every}, on_tick)


def await_batch(query: StreamingQuery, seconds: float = 600.0) -> None:
    """Wait until a micro-batch of the query has been run to its end.

    The signal is Spark's own progress report, which follows the commit of a batch; what a batch writes may be visible before.
    A query that fails or ends without a batch raises.
    """
    until = time.monotonic() + seconds
    while not any("addBatch" in p["durationMs"] for p in query.recentProgress):
        if time.monotonic() > until:
            raise TimeoutError("no micro-batch was finished in time")
        if query.awaitTermination(1) and not any("addBatch" in p["durationMs"] for p in query.recentProgress):
            raise RuntimeError("the query ended without a micro-batch")
