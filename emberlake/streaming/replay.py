"""Replay the warehouse feed through the streaming jobs.

The feed is encoded as Kafka-shaped records and written once, by ordinary
parallel jobs, to a record folder below the shared checkpoint folder.  One
streaming query then reads the folder a few files at a time, so it runs over
several micro-batches, and its sink is read back.  Batch membership is a
property of the data (a fixed width of arrivals), so the answer does not
depend on the number of files, the trigger or the size of the feed.  Used by
the registered stream queries and the tests: stream output must equal the
batch plan on the same data.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.session import scratch_path
from emberlake.functions.parse import iso_text
from emberlake.sources.collection import DocumentCollection
from emberlake.sources.messages import encode_messages, read_records_stream, write_records
from emberlake.streaming.enrich import start_arrival_enrichment, start_event_time_enrichment
from emberlake.operators.rolling import DEFAULT_WINDOW
from emberlake.streaming.rolling import start_rolling_extremes, start_rolling_extremes_by_time

# Consecutive arrivals that make up one batch of the arrival replay.
BATCH_WIDTH = 2_048
FILES_PER_TRIGGER = 4
REJECT_SCHEMA = "topic string, partition int, offset long, value string, reject_reason string"


@contextlib.contextmanager
def _state_partitions(spark: SparkSession):
    """Run the replay with one state/shuffle partition per core of the
    cluster (fixed in the checkpoint at the first start), then restore."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(max(2, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "replay", f"{name}-{uuid.uuid4().hex}")


def _parallelism(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def write_batches(feed: DataFrame, path: str, batch_width: int = BATCH_WIDTH) -> None:
    """Write the encoded feed so that each file holds whole batches, the files
    in the order of their batches: a batch taken after much newer ones is late."""
    batch = F.floor(F.col("offset") / batch_width)
    write_in_order(encode_messages(feed).withColumn("batch", batch), path, order="batch")


def write_in_order(records: DataFrame, path: str, n_files: int | None = None, order: str = "offset") -> None:
    """Write records as files of consecutive offsets (or another order) whose
    modification times ascend, the order in which the file source takes them."""
    spark = records.sparkSession
    ranged = records.repartitionByRange(n_files or _parallelism(records), order).sortWithinPartitions(order)
    write_records(ranged.select("topic", "partition", "offset", "value"), path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f.getPath().getName(), f.getPath()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    now = max((f.getModificationTime() for f in fs.listStatus(folder)), default=0)
    for i, (_, file) in enumerate(files):
        fs.setTimes(file, now - 1000 * (len(files) - i), -1)


def heartbeat(feed: DataFrame, after: str = "1 day") -> DataFrame:
    """One TERRA record ``after`` the newest message: it moves the watermark
    past every real window and opens only a window of its own."""
    last = feed.agg(F.max("event_ts").alias("t"), F.max("arrival").alias("a"))
    return last.select(
        F.lit(S.TOPIC_TERRA).alias("topic"), F.lit(0).cast("int").alias("partition"),
        (F.col("a") + 1).cast("long").alias("offset"),
        F.to_json(F.struct(
            F.lit(-39.0).alias("latitude"), F.lit(141.0).alias("longitude"),
            F.lit(0.0).alias("confidence"), F.lit(0.0).alias("surface_temperature_celcius"),
            iso_text(F.col("t") + F.expr(f"INTERVAL {after}")).alias("created_time"),
            F.lit(S.PRODUCER_TERRA).alias("producer_id"))).alias("value"))


def is_held_back(arrival: str) -> F.Column:
    """The records that the late replay sends after all windows have closed."""
    return F.col(arrival) % 97 == 5


def replay_event_time_enrichment(feed: DataFrame, window: str = "1 hour", delay: str = "10 minutes",
                                 n_files: int = 6, files_per_trigger: int = 2, hold_back: bool = False,
                                 nested: bool = False, root: str | None = None,
                                 collection: DocumentCollection | None = None) -> tuple[DataFrame, DataFrame]:
    """The event-time job over several micro-batches that cut windows apart:
    its sink and its rejects.  With ``hold_back`` some records follow after the heartbeat, to
    a restarted query; their windows are closed by then."""
    spark = feed.sparkSession
    root = root or _run_dir(spark, "enrich-event-time")
    records = encode_messages(feed)
    held = is_held_back("offset") if hold_back else F.lit(False)
    write_in_order(records.where(~held), f"{root}/records", n_files)
    write_records(heartbeat(feed), f"{root}/records")
    for late in (False, True) if hold_back else (False,):
        if late:
            write_records(records.where(held), f"{root}/records")
        with _state_partitions(spark):
            start_event_time_enrichment(
                read_records_stream(spark, f"{root}/records", max_per_trigger=files_per_trigger),
                f"{root}/sink", f"{root}/checkpoint", window, delay, available_now=True,
                rejects_path=f"{root}/rejects", nested=nested, collection=collection).awaitTermination()
    rejects = spark.createDataFrame([], REJECT_SCHEMA) if not hold_back else spark.read.parquet(f"{root}/rejects").drop("epoch")
    return collection.read() if collection else spark.read.parquet(f"{root}/sink").drop("epoch"), rejects


def replay_arrival_enrichment(feed: DataFrame, batch_width: int = BATCH_WIDTH,
                              nested: bool = False, as_coded: bool = False,
                              root: str | None = None,
                              files_per_trigger: int = FILES_PER_TRIGGER,
                              split_files: int | None = None,
                              collection: DocumentCollection | None = None) -> DataFrame:
    """The arrival job over files of whole batches, or over ``split_files``
    files of consecutive offsets, whose micro-batches cut batches apart."""
    spark = feed.sparkSession
    root = root or _run_dir(spark, "enrich-arrival")
    if split_files:
        write_in_order(encode_messages(feed), f"{root}/records", split_files)
    else:
        write_batches(feed, f"{root}/records", batch_width)
    with _state_partitions(spark):
        q = start_arrival_enrichment(
            read_records_stream(spark, f"{root}/records", max_per_trigger=files_per_trigger),
            f"{root}/sink", f"{root}/checkpoint", rejects_path=f"{root}/rejects", nested=nested,
            available_now=True, as_coded=as_coded, batch_width=batch_width, collection=collection)
        q.awaitTermination()
    return collection.read() if collection else spark.read.parquet(f"{root}/sink")


def replay_rolling_extremes(feed: DataFrame, size: int = DEFAULT_WINDOW, files_per_trigger: int = 2) -> DataFrame:
    spark = feed.sparkSession
    root = _run_dir(spark, "rolling")
    write_in_order(encode_messages(feed.where(F.col("producer_id") == S.PRODUCER_CLIMATE)), f"{root}/records")
    with _state_partitions(spark):
        q = start_rolling_extremes(
            read_records_stream(spark, f"{root}/records", topics=[S.TOPIC_CLIMATE], max_per_trigger=files_per_trigger),
            f"{root}/sink", f"{root}/checkpoint", size=size, available_now=True)
        q.awaitTermination()
    return spark.read.parquet(f"{root}/sink").drop("epoch")


def dealt(records: DataFrame, n_partitions: int) -> DataFrame:
    """Records dealt over source partitions, each with its own offsets."""
    n = F.lit(n_partitions)
    return records.withColumn("partition", (F.col("offset") % n).cast("int")).withColumn(
        "offset", F.floor(F.col("offset") / n).cast("long"))


def replay_rolling_extremes_by_time(feed: DataFrame, n_partitions: int = 3, chunks: int = 6, delay: str = "15 days",
                                    size: int = DEFAULT_WINDOW, root: str | None = None) -> DataFrame:
    """The event-ordered rolling job over several partitions that run at
    different paces: partition p's files come p rounds later.

    Of a feed of 30 days a round is some 5 days, so the partitions are some 10 days
    apart, less than the delay; a heartbeat releases the last readings."""
    spark = feed.sparkSession
    root = root or _run_dir(spark, "rolling-time")
    records = encode_messages(feed.where(F.col("producer_id") == S.PRODUCER_CLIMATE))
    span = records.agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).first()
    chunk = F.floor((F.col("offset") - F.lit(span.lo)) * chunks / F.lit((span.hi or 0) - (span.lo or 0) + 1))
    round_ = (chunk + F.col("offset") % n_partitions).alias("round")
    paced = dealt(records.select("*", round_), n_partitions)
    write_in_order(paced, f"{root}/records", chunks, "round")
    write_records(heartbeat(feed, "60 days"), f"{root}/records")
    with _state_partitions(spark):
        q = start_rolling_extremes_by_time(
            read_records_stream(spark, f"{root}/records", topics=[S.TOPIC_CLIMATE, S.TOPIC_TERRA], max_per_trigger=1),
            f"{root}/sink", f"{root}/checkpoint", delay, f"{root}/rejects", size, available_now=True)
        q.awaitTermination()
    return spark.read.parquet(f"{root}/sink").drop("epoch")
