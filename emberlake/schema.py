"""Schemas of the data model (documents, flat facts, messages)."""

from pyspark.sql import types as T

# Field names keep the original spelling ("celcius"): they are the API.
CLIMATE_MEASURES = [
    "air_temperature_celcius",
    "relative_humidity",
    "windspeed_knots",
    "max_wind_speed",
]
HOTSPOT_MEASURES = ["confidence", "surface_temperature_celcius"]

# Column order of a climate record, without its hotspots.
CLIMATE_COLUMNS = [
    "date", "station", *CLIMATE_MEASURES,
    "precipitation", "precipitation_type", "ghi",
]
HOTSPOT_COLUMNS = ["time", "latitude", "longitude", *HOTSPOT_MEASURES]

HOTSPOT_STRUCT = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("surface_temperature_celcius", T.DoubleType()),
    T.StructField("cause", T.StringType()),
])

CLIMATE_DOC = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("station", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in CLIMATE_MEASURES],
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("precipitation_type", T.StringType()),
    T.StructField("ghi", T.DoubleType()),
    T.StructField("hotspots", T.ArrayType(HOTSPOT_STRUCT)),
])

# Zone columns of a stored document: bounds of its hotspots' measures.
ZONE_COLUMNS = [f"{m}_{bound}" for m in HOTSPOT_MEASURES for bound in ("min", "max")]

# A stored document: one part of a climate record's hotspots.
DOCUMENT = T.StructType([
    T.StructField("doc_id", T.StringType()),
    T.StructField("source", T.StringType()),
    *CLIMATE_DOC.fields[:-1],
    T.StructField("part", T.IntegerType()),
    T.StructField("n_hotspots", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in ZONE_COLUMNS],
    CLIMATE_DOC["hotspots"],
])

# Raw CSV layouts: every column read as text, typed by the normalizers.
CLIMATE_HISTORIC_CSV = T.StructType([
    T.StructField(n, T.StringType()) for n in [
        "station", "date", "air_temperature_celcius", "relative_humidity",
        "windspeed_knots", "max_wind_speed", "precipitation ", "GHI_w/m2"]
])
CLIMATE_FEED_CSV = T.StructType([
    T.StructField(n, T.StringType()) for n in [
        "latitude", "longitude", "air_temperature_celcius", "relative_humidity",
        "windspeed_knots", "max_wind_speed", "precipitation ", "GHI_w/m2"]
])
HOTSPOT_HISTORIC_CSV = T.StructType([
    T.StructField(n, T.StringType()) for n in [
        "date", "datetime", "latitude", "longitude", "confidence",
        "surface_temperature_celcius"]
])
SATELLITE_FEED_CSV = T.StructType([
    T.StructField(n, T.StringType()) for n in [
        "latitude", "longitude", "confidence", "surface_temperature_celcius"]
])

# One JSON message on any of the three topics.  Climate messages carry
# created_date, hotspot messages created_time.
MESSAGE = T.StructType([
    T.StructField("producer_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    *[T.StructField(c, T.DoubleType()) for c in CLIMATE_MEASURES],
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("precipitation_type", T.StringType()),
    T.StructField("ghi", T.DoubleType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("surface_temperature_celcius", T.DoubleType()),
    T.StructField("created_date", T.StringType()),
    T.StructField("created_time", T.StringType()),
])

# Producer ids and topic names of the message feeds.
PRODUCER_CLIMATE = "producer_climate"
PRODUCER_AQUA = "producer_hotspot_aqua"
PRODUCER_TERRA = "producer_hotspot_terra"
TOPIC_CLIMATE = "Climate"
TOPIC_AQUA = "Hotspot_AQUA"
TOPIC_TERRA = "Hotspot_TERRA"
KNOWN_PRODUCERS = [PRODUCER_CLIMATE, PRODUCER_AQUA, PRODUCER_TERRA]

# Fixed value: station number stamped on every streamed climate record.
STREAM_STATION = 948700
