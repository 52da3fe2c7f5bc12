"""JSON messages on the three topics: encode, decode with rejects, sources, sinks.

A message source yields Kafka-shaped records (topic, partition, offset,
value).  The Kafka connector is used when ``kafka.bootstrap.servers`` is
given; otherwise a folder of JSON-lines record files is the offline twin
with the same columns, so every job below runs unchanged on either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake import schema as S
from emberlake.functions.parse import iso_text, parse_iso_timestamp

RECORD = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])

TOPIC_OF_PRODUCER = {
    S.PRODUCER_CLIMATE: S.TOPIC_CLIMATE,
    S.PRODUCER_AQUA: S.TOPIC_AQUA,
    S.PRODUCER_TERRA: S.TOPIC_TERRA,
}
ALL_TOPICS = [S.TOPIC_CLIMATE, S.TOPIC_AQUA, S.TOPIC_TERRA]

_PARTITION_SHIFT = 1 << 40

CLIMATE_MESSAGE_FIELDS = ["latitude", "longitude", *S.CLIMATE_MEASURES,
                          "precipitation", "precipitation_type", "ghi"]
HOTSPOT_MESSAGE_FIELDS = ["latitude", "longitude", *S.HOTSPOT_MEASURES]


def _topic_of(pid: Column) -> Column:
    expr = F.lit(None).cast("string")
    for producer, topic in TOPIC_OF_PRODUCER.items():
        expr = F.when(pid == producer, F.lit(topic)).otherwise(expr)
    return expr


def encode_messages(feed: DataFrame) -> DataFrame:
    """Decoded feed rows -> Kafka-shaped records with a JSON ``value``.

    Climate messages carry ``created_date``, hotspot messages ``created_time``
    (ISO text); the feed's ``arrival`` becomes the record offset.
    """
    for c in set(CLIMATE_MESSAGE_FIELDS + HOTSPOT_MESSAGE_FIELDS) - set(feed.columns):
        feed = feed.withColumn(c, F.lit(None).cast("string" if c == "precipitation_type" else "double"))
    pid = F.col("producer_id")
    iso = iso_text("event_ts")
    climate = F.to_json(F.struct(*CLIMATE_MESSAGE_FIELDS, iso.alias("created_date"), pid))
    hotspot = F.to_json(F.struct(*HOTSPOT_MESSAGE_FIELDS, iso.alias("created_time"), pid))
    value = F.when(pid == S.PRODUCER_CLIMATE, climate).otherwise(hotspot)
    return feed.where(pid.isNotNull()).select(
        _topic_of(pid).alias("topic"), F.lit(0).cast("int").alias("partition"),
        F.col("arrival").cast("long").alias("offset"), value.alias("value"))


def arrival_of(offset: str, partition: str) -> Column:
    """A record's number in (partition, offset) order."""
    return F.col(offset) + F.col(partition).cast("long") * F.lit(_PARTITION_SHIFT)


def lane_of(arrival: str) -> Column:
    """The source partition that an arrival number belongs to."""
    return F.floor(F.col(arrival) / F.lit(_PARTITION_SHIFT)).cast("long")


def _lacks(m: str, producer: str, measures: list[str]) -> Column:
    """A message of ``producer`` without one of its measures."""
    missing = F.lit(False)
    for c in measures:
        missing = missing | F.col(f"{m}.{c}").isNull()
    return (F.col(f"{m}.producer_id") == producer) & missing


def decode_records(records: DataFrame) -> DataFrame:
    """P5: parse every record; adds ``m`` (the parsed message), ``arrival``,
    ``event_ts`` and ``reject_reason`` (NULL for a good message)."""
    m = F.from_json(F.col("value").cast("string"), S.MESSAGE)
    # In a generator the message is parsed once; as a plain column it would be
    # copied into, and parsed for, every expression that reads one of its fields.
    parsed = records.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"),
                            F.explode(F.array(m)).alias("m"))
    event_ts = parse_iso_timestamp(F.coalesce(F.col("m.created_date"), F.col("m.created_time")))
    reason = (F.when(F.col("m").isNull() | F.col("m.producer_id").isNull(), F.lit("undecodable"))
               .when(~F.col("m.producer_id").isin(*S.KNOWN_PRODUCERS), F.lit("unknown_producer"))
               .when(F.col("m.latitude").isNull() | F.col("m.longitude").isNull(), F.lit("no_position"))
               .when(event_ts.isNull(), F.lit("no_timestamp"))
               .when(_lacks("m", S.PRODUCER_CLIMATE, [*S.CLIMATE_MEASURES, "ghi"]), F.lit("no_measure"))
               .when(_lacks("m", S.PRODUCER_AQUA, S.HOTSPOT_MEASURES)
                     | _lacks("m", S.PRODUCER_TERRA, S.HOTSPOT_MEASURES), F.lit("no_measure")))
    return parsed.select("*", arrival_of("offset", "partition").alias("arrival"), event_ts.alias("event_ts"),
                         reason.alias("reject_reason"))


_MESSAGE_COLUMNS = ["latitude", "longitude", *S.CLIMATE_MEASURES, "precipitation",
                    "precipitation_type", "ghi", *S.HOTSPOT_MEASURES]


def decode_messages(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good messages in feed layout, and the rejects side-output.

    Undecodable text, unknown producers and messages without a position, a
    timestamp or one of their producer's measures go to the rejects instead
    of failing the batch.
    """
    return split_decoded(decode_records(records))


def split_decoded(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good messages and the rejects of ``decode_records``."""
    good = d.where(F.col("reject_reason").isNull()).select(
        "arrival", F.col("m.producer_id").alias("producer_id"), "event_ts",
        *[F.col(f"m.{c}").alias(c) for c in _MESSAGE_COLUMNS])
    rejects = d.where(F.col("reject_reason").isNotNull()).select(
        "topic", "partition", "offset", "value", "reject_reason")
    return good, rejects


def damaged_records(feed: DataFrame) -> DataFrame:
    """The encoded feed with some records damaged by their offset: text that
    is no message, an unknown producer, a missing measure, no position."""
    records, at = encode_messages(feed), F.col("offset") % 50
    value = (F.when(at == 0, F.lit("garbage"))
              .when(at == 1, F.regexp_replace("value", "producer_(climate|hotspot_[a-z]+)", "producer_x"))
              .when(at == 2, F.regexp_replace("value", '"(ghi|confidence)":[0-9.]+,', ""))
              .when(at == 3, F.regexp_replace("value", '"latitude":[-0-9.E]+,', ""))
              .otherwise(F.col("value")))
    return records.withColumn("value", value)


def write_records(records: DataFrame, path: str | None = None, mode: str = "append",
                  kafka_servers: str | None = None) -> None:
    """Publish records.  Kafka when servers are given, else JSON-lines files."""
    if kafka_servers:
        (records.select("topic", F.col("value").cast("binary").alias("value"))
         .write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save())
        return
    records.write.mode(mode).json(path)


def read_records_stream(spark: SparkSession, path: str | None = None,
                        topics: list[str] | None = None, starting: str = "latest",
                        kafka_servers: str | None = None,
                        max_per_trigger: int | None = None,
                        kafka_options: dict | None = None) -> DataFrame:
    """Streaming records from Kafka topics, or from the record folder."""
    topics = topics or ALL_TOPICS
    if kafka_servers:
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", kafka_servers)
             .option("subscribe", ",".join(topics))
             .option("startingOffsets", starting))
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        for k, v in (kafka_options or {}).items():
            r = r.option(k, v)
        df = r.load()
        return df.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    r = spark.readStream.schema(RECORD)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.json(path).where(F.col("topic").isin(*topics))


def read_records(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Batch read of the record folder (the replay of a stream)."""
    df = spark.read.schema(RECORD).json(path)
    return df.where(F.col("topic").isin(*(topics or ALL_TOPICS)))
