"""The enrichment job as Structured Streaming queries.

``start_arrival_enrichment`` keeps the original semantics: a micro-batch
*is* the batch (one climate record per micro-batch, hotspots paired within
it).  ``start_event_time_enrichment`` groups messages by event-time window
instead, behind a watermark, so a slow message still meets the climate
record of its own window and a late one is rejected.  Both call the batch plans of
``operators.enrich`` inside ``foreachBatch`` and write each batch's
partition with dynamic partition overwrite: a retried micro-batch replaces
its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlake.functions.parse import ntz_from_micros, wall_micros
from emberlake.operators.enrich import enrich_documents, enrich_flat, stored_documents
from emberlake.operators.pairing import coded_block
from emberlake.sources.collection import DocumentCollection
from emberlake.sources.messages import RECORD, decode_messages, decode_records, lane_of, split_decoded
from emberlake.streaming.state import EpochTable, interval_micros, overwrite_partitions

def _trigger(writer, processing_time: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=processing_time or "10 seconds")


# Batches of fixed width stay open for late parts until the newest batch of
# their source partition is this many ahead.
KEEP_BATCHES = 4


def start_arrival_enrichment(records: DataFrame, sink_path: str | None, checkpoint_path: str,
                             rejects_path: str | None = None, nested: bool = True,
                             processing_time: str | None = "10 seconds",
                             available_now: bool = False, as_coded: bool = False,
                             batch_width: int | None = None,
                             keep_batches: int = KEEP_BATCHES,
                             collection: DocumentCollection | None = None) -> StreamingQuery:
    """Each micro-batch becomes one batch (``batch_id`` = epoch id).

    With ``batch_width`` a batch is that many consecutive arrivals instead
    (``batch_id`` = arrival div width), however the trigger cuts the stream.
    Messages of the newest ``keep_batches`` batches of each source partition
    stay in a pending table; when a further part of one of them arrives, the
    batch is enriched again from all its messages and its output replaced.
    A part that comes later still goes to the rejects (``late_batch``).

    ``as_coded`` keeps the original loop's duplicated/lost hotspots (Q1); it
    counts within batches, so it needs a width, which bounds their grids.  With a
    ``collection`` the documents of a batch are committed there (and replace those of
    an earlier part of the batch) instead of to ``sink_path``.
    """
    if as_coded and not batch_width:
        raise ValueError("the as-coded pairing needs batch_width, which bounds its groups")
    pending_path = f"{checkpoint_path.rstrip('/')}-pending"

    def write_batches(msgs: DataFrame) -> None:
        kept: list[DataFrame] = []
        flat = enrich_flat(msgs, check_sizes=False, as_coded=as_coded, block=coded_block(batch_width or 1), kept=kept)
        try:
            if collection:
                collection.append_each(stored_documents(flat), "batch", "arrival")
                return
            out = enrich_documents(flat) if nested else flat
            if batch_width and not as_coded:
                out = out.repartition("batch")  # a batch of bounded width is one file, not one a task
            overwrite_partitions(out.withColumnRenamed("batch", "batch_id"), sink_path, "batch_id")
        finally:
            for df in kept:
                df.unpersist()

    def write_rejects(rejects: DataFrame, epoch_id: int) -> None:
        if rejects_path:
            overwrite_partitions(rejects.withColumn("batch_id", F.lit(epoch_id).cast("long")), rejects_path, "batch_id")

    def micro_batch(batch_df: DataFrame, epoch_id: int) -> None:
        # Read by several branches below: one pass over the source, parsed once and kept.
        decoded = decode_records(batch_df).persist()
        try:
            if decoded.count() == 0:
                return
            good, rejects = split_decoded(decoded)
            write_batches(good.withColumn("batch", F.lit(epoch_id).cast("long")))
            write_rejects(rejects, epoch_id)
        finally:
            decoded.unpersist()

    def fixed_width(batch_df: DataFrame, epoch_id: int) -> None:
        decoded = decode_records(batch_df).persist()
        try:
            if decoded.count() == 0:
                return
            msgs, late, lanes, pending = _placed_parts(decoded, batch_width, keep_batches, pending_path, epoch_id)
            write_batches(msgs)
            write_rejects(split_decoded(decoded)[1].unionByName(late), epoch_id)
            pending.write(lanes, epoch_id)
        finally:
            decoded.unpersist()

    w = (records.writeStream.foreachBatch(fixed_width if batch_width else micro_batch)
         .option("checkpointLocation", checkpoint_path))
    return _trigger(w, processing_time, available_now).start()


def _placed_parts(decoded: DataFrame, width: int, keep: int, path: str,
                  epoch_id: int) -> tuple[DataFrame, DataFrame, DataFrame, EpochTable]:
    """The messages of every batch that a micro-batch adds to, its late
    records, and the rows of the pending table that it leaves.

    A pending row is a record (``newest`` null) or a source partition's newest
    batch, so the table holds at most ``keep + 1`` batches of each partition."""
    record = [f"{f.name} {f.dataType.simpleString()}" for f in RECORD]
    pending = EpochTable(decoded.sparkSession, path, ", ".join([*record, "lane long", "batch long", "newest long"]))
    batch = F.floor(F.col("arrival") / width).cast("long")
    new = decoded.where(F.col("reject_reason").isNull()).select(
        *RECORD.names, lane_of("arrival").alias("lane"), batch.alias("batch"))
    before = pending.before(epoch_id).persist()
    known = before.where(F.col("newest").isNotNull()).select("lane", "newest")
    # One row for each source partition.
    old = new.join(F.broadcast(known), "lane", "left")
    is_late = F.coalesce(F.col("batch") < F.col("newest") - keep, F.lit(False))
    late = old.where(is_late).select(*RECORD.names, F.lit("late_batch").alias("reject_reason"))
    fresh = old.where(~is_late).select(*RECORD.names, "lane", "batch")
    held = before.where(F.col("newest").isNull()).select(*RECORD.names, "lane", "batch")
    parts = fresh.unionByName(held.join(fresh.select("batch").distinct(), "batch", "left_semi").select(*fresh.columns))
    msgs = decode_messages(parts.select(*RECORD.names))[0].withColumn("batch", batch)
    newest = fresh.select("lane", F.col("batch").alias("newest")).unionByName(known).groupBy("lane").agg(
        F.max("newest").alias("newest"))
    left = fresh.unionByName(held).join(F.broadcast(newest), "lane").where(F.col("batch") >= F.col("newest") - keep)
    rows = left.withColumn("newest", F.lit(None).cast("long")).unionByName(newest, allowMissingColumns=True)
    return msgs, late, rows.select(*RECORD.names, "lane", "batch", "newest"), pending


# A row is an open window (its start, the messages staged for it, the first
# micro-batch that staged one) or the watermark (start null, micros in ``n``).
WINDOW_SCHEMA = "start long, n long, first_epoch long"


def start_event_time_enrichment(records: DataFrame, sink_path: str | None, checkpoint_path: str,
                                window: str = "1 hour", delay: str = "10 minutes",
                                processing_time: str | None = "10 seconds",
                                available_now: bool = False, rejects_path: str | None = None,
                                nested: bool = False, collection: DocumentCollection | None = None) -> StreamingQuery:
    """Enrichment per closed event-time window (``batch`` = window start).

    A micro-batch appends its messages to a staging table (a folder per
    micro-batch, sorted by window); the state has one counter a window, so its size does
    not depend on the messages.  A window closes when the watermark, the
    newest event time less ``delay``, reaches its end: its messages are then read back and
    enriched.  A message whose window had closed before its micro-batch goes to the rejects
    (``late_window``) with the unreadable ones.  Windows follow the wall clock in any session time zone.

    Output is the flat enrichment (one row per climate record x hotspot), or
    ``nested`` climate documents, or documents committed to a ``collection``, partitioned by ``epoch`` (the micro-batch that closed the
    windows): a retried micro-batch starts from the same state and replaces its own folders.
    """
    spark = records.sparkSession
    width, lag = interval_micros(spark, window), interval_micros(spark, delay)
    root = checkpoint_path.rstrip("/")
    staging = f"{root}-staging"

    def write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
        overwrite_partitions(df.withColumn("epoch", F.lit(epoch_id).cast("long")), path, "epoch")

    def per_batch(batch_df: DataFrame, epoch_id: int) -> None:
        state = EpochTable(batch_df.sparkSession, f"{root}-windows", WINDOW_SCHEMA)
        staged = EpochTable(batch_df.sparkSession, staging, "start long")
        decoded = decode_records(batch_df).persist()
        before = state.before(epoch_id).persist()
        try:
            if decoded.count() == 0:
                return
            good, rejects = split_decoded(decoded)
            micros = wall_micros("event_ts")
            placed = good.select("*", (F.floor(micros / F.lit(width)) * F.lit(width)).cast("long").alias("start"))
            passed = before.where("start IS NULL").agg(F.max("n")).first()[0]  # one row
            newest = good.agg(F.max(micros)).first()[0]
            marks = [m for m in (passed, None if newest is None else newest - lag) if m is not None]
            mark = max(marks) if marks else None
            is_late = _closed(width, passed)
            late = decoded.join(placed.where(is_late).select("arrival"), "arrival", "left_semi").select(
                *RECORD.names, F.lit("late_window").alias("reject_reason"))
            fresh = placed.where(~is_late)
            write_epoch(fresh.sortWithinPartitions("start"), staging, epoch_id)
            if rejects_path:
                write_epoch(rejects.unionByName(late), rejects_path, epoch_id)
            counts = fresh.groupBy("start").agg(F.count("*").alias("n")).withColumn(
                "first_epoch", F.lit(epoch_id).cast("long"))
            windows = before.where("start IS NOT NULL").unionByName(counts).groupBy("start").agg(
                F.sum("n").alias("n"), F.min("first_epoch").alias("first_epoch")).persist()
            closing = windows.where(_closed(width, mark)).agg(F.min("first_epoch")).first()[0]
            if closing is not None:
                due = (batch_df.sparkSession.read.schema(f"{_STAGED_SCHEMA}, epoch long").parquet(staging)
                       .where(F.col("epoch").between(closing, epoch_id) & _closed(width, mark) & ~_closed(width, passed)))
                flat = enrich_flat(due.withColumn("batch", ntz_from_micros(F.col("start"))), check_sizes=False)
                if collection:
                    collection.append(stored_documents(flat), f"event-time/{epoch_id}")
                else:
                    write_epoch(enrich_documents(flat) if nested else flat, sink_path, epoch_id)
            marker = batch_df.sparkSession.range(1).select(
                F.lit(None).cast("long").alias("start"), F.lit(mark).cast("long").alias("n"),
                F.lit(None).cast("long").alias("first_epoch"))
            # A retry of this micro-batch needs the folders of the windows that were open before it.
            needed = before.agg(F.min("first_epoch")).first()[0]
            state.write(windows.where(~_closed(width, mark)).unionByName(marker), epoch_id)
            staged.drop_below(epoch_id if needed is None else needed)
            windows.unpersist()
        finally:
            decoded.unpersist()
            before.unpersist()

    w = records.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    return _trigger(w, processing_time, available_now).start()


_STAGED_SCHEMA = ("start long, arrival long, producer_id string, event_ts timestamp_ntz, latitude double, longitude double, "
                  "air_temperature_celcius double, relative_humidity double, windspeed_knots double, max_wind_speed double, "
                  "precipitation double, precipitation_type string, ghi double, confidence double, "
                  "surface_temperature_celcius double")


def _closed(width: int, mark: int | None) -> F.Column:
    """Windows whose end the watermark has reached: a plain bound on
    ``start``, so a scan of staged messages skips other row groups."""
    return F.lit(False) if mark is None else F.col("start") <= F.lit(mark - width)


def start_rejects(records: DataFrame, path: str, checkpoint_path: str,
                  processing_time: str | None = "10 seconds",
                  available_now: bool = False) -> StreamingQuery:
    """Undecodable / unknown / incomplete messages to an exactly-once file sink
    (for a consumer of the rejects alone; both enrichment jobs write their own)."""
    _, rejects = decode_messages(records)
    w = (rejects.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint_path))
    return _trigger(w, processing_time, available_now).start()


def run_for(queries: StreamingQuery | list[StreamingQuery], seconds: float = 600) -> None:
    """T5: run a bounded time, then stop every query gracefully."""
    qs = queries if isinstance(queries, list) else [queries]
    qs[0].awaitTermination(seconds)
    for q in qs:
        q.stop()
