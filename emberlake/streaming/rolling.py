"""T4: live rolling extremes, a carry table between micro-batches.

``start_rolling_extremes`` takes the readings of one source partition in
arrival order.  ``start_rolling_extremes_by_time`` takes any number of
partitions: a reorder buffer holds the readings until the watermark (the newest event
time seen, less a delay) has passed them, and releases them in the order of
(event time, partition, offset).

Each micro-batch unions its readings with the carry of the epoch before (the
newest ``size - 1`` readings of each stream with their sequence numbers) and
runs the block-and-halo plan of ``operators.rolling`` on both, so a stream's
readings are spread over tasks however many arrive at once.  Output and carry
are written per epoch with partition overwrite: a retried micro-batch reads
the same older carry and replaces its own output.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlake.operators.rolling import DEFAULT_WINDOW, rolling_extremes
from emberlake.functions.parse import wall_micros
from emberlake.plans.reports import TIME_BLOCK, climate_readings, timed_readings
from emberlake.sources.messages import decode_messages, decode_records, split_decoded
from emberlake.streaming.state import EpochTable, interval_micros, overwrite_partitions

CARRY_SCHEMA = "stream string, arrival long, day_label string, temperature double, seq long, epoch long"


def _carry_before(spark: SparkSession, path: str, epoch_id: int) -> DataFrame:
    """The carry that the newest epoch below ``epoch_id`` left."""
    try:
        carry = spark.read.schema(CARRY_SCHEMA).parquet(path).where(F.col("epoch") < epoch_id)
    except AnalysisException:  # no epoch yet
        return spark.createDataFrame([], CARRY_SCHEMA).drop("epoch")
    newest = carry.agg(F.max("epoch").alias("e")).first().e
    return carry.where(F.col("epoch") == F.lit(newest)).drop("epoch")


def _write_epoch(df: DataFrame, path: str, epoch_id: int) -> None:
    (df.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))


def start_rolling_extremes(records: DataFrame, sink_path: str, checkpoint_path: str,
                           size: int = DEFAULT_WINDOW, processing_time: str | None = "10 seconds",
                           available_now: bool = False) -> StreamingQuery:
    carry_path = f"{checkpoint_path.rstrip('/')}-carry"

    def per_batch(batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        new = climate_readings(decode_messages(batch_df)[0]).select("stream", "arrival", "day_label", "temperature")
        carry = _carry_before(spark, carry_path, epoch_id)
        # At most size - 1 rows a stream; base is the number before the carry.
        base = carry.groupBy("stream").agg((F.min("seq") - 1).alias("base"), F.max("arrival").alias("last"))
        readings = carry.drop("seq").unionByName(new).persist()
        try:
            rolled = rolling_extremes(readings, ["stream"], size=size).join(base, "stream", "left")
            fresh = rolled.where(F.col("last").isNull() | (F.col("arrival") > F.col("last")))
            _write_epoch(fresh.withColumn("seq", F.col("seq") + F.coalesce("base", F.lit(0))).drop("base", "last"),
                         sink_path, epoch_id)
            counted = readings.groupBy("stream").agg(F.count("*").alias("n")).join(base, "stream", "left")
            newest = _newest(readings, size - 1).join(counted, "stream")
            seq = F.coalesce("base", F.lit(0)) + F.col("n") - F.col("back") + 1
            _write_epoch(newest.select("stream", "arrival", "day_label", "temperature", seq.alias("seq")), carry_path, epoch_id)
        finally:
            readings.unpersist()

    w = records.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def _newest(readings: DataFrame, n: int) -> DataFrame:
    """The ``n`` latest readings of each stream, ``back`` = 1 for the last.

    Spark keeps at most ``n`` rows a stream and task before the shuffle, as
    the rank is filtered by a constant."""
    back = F.row_number().over(Window.partitionBy("stream").orderBy(F.desc("arrival")))
    return readings.withColumn("back", back).where(F.col("back") <= n)


# A row is a buffered reading (seq null), a released one of the newest (with
# its number) or the watermark (stream null).
BUFFER_SCHEMA = "stream string, micros long, arrival long, day_label string, temperature double, seq long"


def start_rolling_extremes_by_time(records: DataFrame, sink_path: str, checkpoint_path: str, delay: str = "10 minutes",
                                   rejects_path: str | None = None, size: int = DEFAULT_WINDOW,
                                   processing_time: str | None = "10 seconds",
                                   available_now: bool = False) -> StreamingQuery:
    """T4 over several source partitions, in event order.

    A reading is released once the newest event time of any message is
    ``delay`` ahead of it, and then numbered and rolled together with the newest
    ``size - 1`` released before.  One that comes after the watermark has passed its time is
    not placed any more: it goes to the rejects (``late``).  The buffer holds the
    readings of the last ``delay`` only.
    """
    spark = records.sparkSession
    lag = interval_micros(spark, delay)
    reading = ["stream", "micros", "arrival", "day_label", "temperature"]

    def per_batch(batch_df: DataFrame, epoch_id: int) -> None:
        table = EpochTable(batch_df.sparkSession, f"{checkpoint_path.rstrip('/')}-buffer", BUFFER_SCHEMA)
        decoded = decode_records(batch_df).persist()
        state = table.before(epoch_id).persist()
        try:
            if decoded.count() == 0:
                return
            good, rejects = split_decoded(decoded)
            passed = state.where("stream IS NULL").agg(F.max("micros")).first()[0]  # one row
            newest = good.agg(F.max(wall_micros("event_ts"))).first()[0]
            marks = [m for m in (passed, None if newest is None else newest - lag) if m is not None]
            mark = max(marks) if marks else None
            new = timed_readings(good)
            is_late = F.col("micros") <= F.lit(passed) if passed is not None else F.lit(False)
            late = decoded.join(new.where(is_late).select("arrival"), "arrival", "left_semi").select(
                "topic", "partition", "offset", "value", F.lit("late").alias("reject_reason"))
            pool = state.where("stream IS NOT NULL AND seq IS NULL").select(*reading).unionByName(new.where(~is_late))
            due = F.col("micros") <= F.lit(mark) if mark is not None else F.lit(False)
            carry = state.where("seq IS NOT NULL")
            base = F.broadcast(carry.groupBy("stream").agg((F.min("seq") - 1).alias("base"), F.max("seq").alias("last")))
            ready = pool.where(due).unionByName(carry.select(*reading)).persist()
            rolled = rolling_extremes(ready, ["stream"], size=size, order="micros", block_width=TIME_BLOCK)
            seq = F.col("seq") + F.coalesce("base", F.lit(0))
            fresh = rolled.join(base, "stream", "left").withColumn("seq", seq).where(
                F.col("seq") > F.coalesce("last", F.lit(0))).drop("base", "last")
            overwrite_partitions(fresh.withColumn("epoch", F.lit(epoch_id).cast("long")), sink_path, "epoch")
            if rejects_path:
                out = rejects.unionByName(late).withColumn("epoch", F.lit(epoch_id).cast("long"))
                overwrite_partitions(out, rejects_path, "epoch")
            back = F.row_number().over(Window.partitionBy("stream").orderBy(F.desc("micros"), F.desc("arrival")))
            counted = ready.groupBy("stream").agg(F.count("*").alias("n")).join(base, "stream", "left")
            kept = ready.withColumn("back", back).where(F.col("back") < size).join(counted, "stream").select(
                *reading, (F.coalesce("base", F.lit(0)) + F.col("n") - F.col("back") + 1).alias("seq"))
            none = F.lit(None)
            waiting = pool.where(~due).withColumn("seq", none.cast("long"))
            marker = batch_df.sparkSession.range(1).select(
                none.cast("string").alias("stream"), F.lit(mark).cast("long").alias("micros"), none.cast("long").alias("arrival"),
                none.cast("string").alias("day_label"), none.cast("double").alias("temperature"), none.cast("long").alias("seq"))
            table.write(kept.unionByName(waiting).unionByName(marker), epoch_id)
            ready.unpersist()
        finally:
            decoded.unpersist()
            state.unpersist()

    w = records.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
