"""DuckDB SQL text of every registered query, for the side-by-side check.

The views ``orders lineitem events ...`` are the warehouse tables.  The
CTEs below restate the climate model in plain SQL from its definition
(not from the Spark code path): the precipitation amount is computed as a
number rather than parsed, the geohash uses integer division rather than
shifts, and window functions replace the skew-safe numbering.
"""

from __future__ import annotations

# Consecutive arrivals in one batch of the arrival streams.
BATCH_WIDTH = 2048

# Fixed value: the geohash base-32 alphabet.
_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geo_cell_sql(lat: str, lon: str, precision: int = 3) -> str:
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    x = (f"least(greatest(CAST(floor(({lon} + 180.0) * {float(1 << lon_bits)} / 360.0) AS BIGINT), 0), "
         f"{(1 << lon_bits) - 1})")
    y = (f"least(greatest(CAST(floor(({lat} + 90.0) * {float(1 << lat_bits)} / 180.0) AS BIGINT), 0), "
         f"{(1 << lat_bits) - 1})")
    chars = []
    for c in range(precision):
        terms = []
        for j in range(5):
            k = 5 * c + j
            if k % 2 == 0:
                src, b = x, lon_bits - 1 - k // 2
            else:
                src, b = y, lat_bits - 1 - k // 2
            terms.append(f"((({src}) // {1 << b}) % 2) * {1 << (4 - j)}")
        chars.append(f"substr('{_ALPHABET}', CAST(1 + {' + '.join(terms)} AS INTEGER), 1)")
    return (f"(CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 "
            f"THEN {' || '.join(chars)} END)")


CLIMATE = """
climate_key AS (
  SELECT CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS k,
         arg_min(o_custkey, o_orderkey) AS c
  FROM orders GROUP BY 1),
climate AS (
  SELECT date,
         CAST(948700 + c % 3 AS INTEGER) AS station,
         CAST(5 + k % 28 AS DOUBLE) AS air_temperature_celcius,
         CAST(30 + k % 38 AS DOUBLE) AS relative_humidity,
         CAST(1 + k % 19 AS DOUBLE) AS windspeed_knots,
         CAST(5 + k % 26 AS DOUBLE) AS max_wind_speed,
         CAST(k % 60 AS DOUBLE) / 100.0 AS precipitation,
         substr('GIAB', CAST(1 + k % 4 AS INTEGER), 1) AS precipitation_type,
         CAST(47 + k % 219 AS DOUBLE) AS ghi
  FROM climate_key)"""

HOTSPOT = """
hotspot AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(l_shipdate + to_seconds((l_orderkey * 7919) % 86400) AS TIMESTAMP) AS time,
         CAST(-39.0 AS DOUBLE) + CAST((l_partkey * 7) % 48 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS latitude,
         CAST(141.0 AS DOUBLE) + CAST((l_suppkey * 13) % 84 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS longitude,
         CAST(50 + l_partkey % 51 AS DOUBLE) AS confidence,
         CAST(28 + (l_orderkey + l_linenumber) % 96 AS DOUBLE) AS surface_temperature_celcius
  FROM lineitem)"""

FACTS = """
facts AS (
  SELECT c.date, c.station, c.air_temperature_celcius, c.relative_humidity,
         c.windspeed_knots, c.max_wind_speed, c.precipitation, c.precipitation_type, c.ghi,
         h.time, h.latitude, h.longitude, h.confidence, h.surface_temperature_celcius
  FROM hotspot h JOIN climate c ON h.date = c.date)"""


def _feed(unit: str = "hour", name: str = "feed") -> str:
    cl = "CASE WHEN event_type = 'view' THEN {} END"
    hs = "CASE WHEN event_type IN ('click', 'signup', 'purchase', 'error') THEN {} END"
    return f"""
{name} AS (
  SELECT event_id AS arrival,
         CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS batch,
         CASE WHEN event_type = 'view' THEN 'producer_climate'
              WHEN event_type IN ('click', 'signup') THEN 'producer_hotspot_aqua'
              WHEN event_type IN ('purchase', 'error') THEN 'producer_hotspot_terra' END AS producer_id,
         CAST(ts AS TIMESTAMP) AS event_ts,
         CAST(-39.0 AS DOUBLE) + CAST((user_id * 7) % 48 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS latitude,
         CAST(141.0 AS DOUBLE) + CAST((user_id * 13) % 84 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS longitude,
         {cl.format("CAST(5 + event_id % 28 AS DOUBLE)")} AS air_temperature_celcius,
         {cl.format("CAST(30 + event_id % 38 AS DOUBLE)")} AS relative_humidity,
         {cl.format("CAST(1 + event_id % 19 AS DOUBLE)")} AS windspeed_knots,
         {cl.format("CAST(5 + event_id % 26 AS DOUBLE)")} AS max_wind_speed,
         {cl.format("CAST(event_id % 60 AS DOUBLE) / 100.0")} AS precipitation,
         {cl.format("substr('GIAB', CAST(1 + event_id % 4 AS INTEGER), 1)")} AS precipitation_type,
         {cl.format("CAST(100 + event_id % 150 AS DOUBLE)")} AS ghi,
         {hs.format("CAST(50 + event_id % 51 AS DOUBLE)")} AS confidence,
         {hs.format("CAST(30 + event_id % 90 AS DOUBLE)")} AS surface_temperature_celcius
  FROM events)"""


PAIRS = f"""
sat AS (
  SELECT *, {geo_cell_sql('latitude', 'longitude')} AS geo_cell FROM feed
  WHERE producer_id IN ('producer_hotspot_aqua', 'producer_hotspot_terra')),
num AS (
  SELECT *, row_number() OVER (PARTITION BY batch, producer_id, geo_cell ORDER BY arrival) AS rn
  FROM sat),
a AS (SELECT * FROM num WHERE producer_id = 'producer_hotspot_aqua'),
t AS (SELECT * FROM num WHERE producer_id = 'producer_hotspot_terra'),
pairs AS (
  SELECT coalesce(a.batch, t.batch) AS batch,
         coalesce(a.geo_cell, t.geo_cell) AS geo_cell,
         CASE WHEN a.arrival IS NOT NULL THEN a.arrival ELSE t.arrival END AS arrival,
         CASE WHEN a.arrival IS NOT NULL THEN a.event_ts ELSE t.event_ts END AS time,
         CASE WHEN a.arrival IS NOT NULL THEN a.latitude ELSE t.latitude END AS latitude,
         CASE WHEN a.arrival IS NOT NULL THEN a.longitude ELSE t.longitude END AS longitude,
         CASE WHEN a.arrival IS NOT NULL AND t.arrival IS NOT NULL
              THEN (a.confidence + t.confidence) / 2.0
              WHEN a.arrival IS NOT NULL THEN a.confidence ELSE t.confidence END AS confidence,
         CASE WHEN a.arrival IS NOT NULL AND t.arrival IS NOT NULL
              THEN (a.surface_temperature_celcius + t.surface_temperature_celcius) / 2.0
              WHEN a.arrival IS NOT NULL THEN a.surface_temperature_celcius
              ELSE t.surface_temperature_celcius END AS surface_temperature_celcius,
         CASE WHEN a.arrival IS NOT NULL AND t.arrival IS NOT NULL THEN 'both'
              WHEN a.arrival IS NOT NULL THEN 'aqua' ELSE 'terra' END AS satellite,
         (a.arrival IS NOT NULL AND t.arrival IS NOT NULL) AS merged
  FROM a FULL OUTER JOIN t
    ON a.batch = t.batch AND a.geo_cell = t.geo_cell AND a.rn = t.rn)"""

LATEST = f"""
latest AS (
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY batch ORDER BY arrival DESC) AS rk
    FROM feed WHERE producer_id = 'producer_climate') WHERE rk = 1),
climate_batch AS (
  SELECT batch, CAST(event_ts AS DATE) AS date, CAST(948700 AS INTEGER) AS station,
         air_temperature_celcius, relative_humidity, windspeed_knots, max_wind_speed,
         precipitation, precipitation_type, ghi,
         {geo_cell_sql('latitude', 'longitude')} AS geo_cell
  FROM latest)"""

ENRICHED = """
enriched AS (
  SELECT c.batch, c.date, c.station, c.air_temperature_celcius, c.relative_humidity,
         c.windspeed_knots, c.max_wind_speed, c.precipitation, c.precipitation_type, c.ghi,
         c.geo_cell, p.time, p.latitude, p.longitude, p.confidence,
         p.surface_temperature_celcius,
         CASE WHEN p.arrival IS NULL THEN NULL
              WHEN c.air_temperature_celcius > 20 AND c.ghi > 180 THEN 'natural'
              ELSE 'other' END AS cause,
         p.merged
  FROM climate_batch c LEFT JOIN pairs p ON c.batch = p.batch AND c.geo_cell = p.geo_cell)"""

CLIMATE_COLS = ("date, station, air_temperature_celcius, relative_humidity, windspeed_knots, "
                "max_wind_speed, precipitation, precipitation_type, ghi")


PAIRS_AS_CODED = f"""
sat AS (
  SELECT *, {geo_cell_sql('latitude', 'longitude')} AS geo_cell FROM feed
  WHERE producer_id IN ('producer_hotspot_aqua', 'producer_hotspot_terra')),
num AS (
  SELECT *, row_number() OVER (PARTITION BY batch, producer_id, geo_cell ORDER BY arrival) AS rn,
         row_number() OVER (PARTITION BY batch, producer_id ORDER BY arrival) - 1 AS seq
  FROM sat),
a AS (SELECT * FROM num WHERE producer_id = 'producer_hotspot_aqua'),
t AS (SELECT * FROM num WHERE producer_id = 'producer_hotspot_terra'),
nt AS (SELECT batch, count(*) AS n_t FROM t GROUP BY batch),
am AS (
  SELECT a.*, t.seq AS t_seq, t.confidence AS t_conf, t.surface_temperature_celcius AS t_surf,
         coalesce(nt.n_t, 0) AS n_t
  FROM a LEFT JOIN t ON a.batch = t.batch AND a.geo_cell = t.geo_cell AND a.rn = t.rn
  LEFT JOIN nt ON a.batch = nt.batch),
ap AS (
  SELECT am.*,
         coalesce(sum(CASE WHEN t_seq IS NOT NULL THEN 1 ELSE 0 END) OVER (
           PARTITION BY batch ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior,
         (SELECT count(*) FROM am q WHERE q.batch = am.batch AND q.t_seq IS NOT NULL
            AND q.seq < am.seq AND q.t_seq < am.t_seq) AS prior_before
  FROM am),
acopies AS (
  SELECT *, CASE WHEN n_t = 0 THEN 1 WHEN t_seq IS NOT NULL THEN t_seq - prior_before + 1
                 ELSE n_t - prior END AS copies
  FROM ap),
pairs AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT batch, geo_cell, arrival, event_ts AS time, latitude, longitude,
           CASE WHEN t_seq IS NOT NULL THEN (confidence + t_conf) / 2.0 ELSE confidence END AS confidence,
           CASE WHEN t_seq IS NOT NULL THEN (surface_temperature_celcius + t_surf) / 2.0
                ELSE surface_temperature_celcius END AS surface_temperature_celcius,
           CASE WHEN t_seq IS NOT NULL THEN 'both' ELSE 'aqua' END AS satellite,
           (t_seq IS NOT NULL) AS merged,
           unnest(range(CAST(copies AS BIGINT))) AS k
    FROM acopies)
  UNION ALL
  SELECT batch, geo_cell, arrival, event_ts AS time, latitude, longitude, confidence,
         surface_temperature_celcius, 'terra' AS satellite, false AS merged
  FROM t WHERE NOT EXISTS (
    SELECT 1 FROM a WHERE a.batch = t.batch AND a.geo_cell = t.geo_cell AND a.rn = t.rn))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ROLLING = """
readings AS (
  SELECT producer_id AS stream, arrival, strftime(event_ts, '%-d/%m/%y') AS day_label,
         air_temperature_celcius AS temperature,
         row_number() OVER (ORDER BY arrival) AS seq
  FROM feed WHERE producer_id = 'producer_climate'),
framed AS (
  SELECT *, count(*) OVER w AS n,
         min({'v': temperature, 's': seq, 'l': day_label}) OVER w AS lo,
         max({'v': temperature, 's': -seq, 'l': day_label}) OVER w AS hi
  FROM readings
  WINDOW w AS (ORDER BY seq ROWS BETWEEN 10 PRECEDING AND CURRENT ROW))"""


MARKERS = """
SELECT latitude, longitude,
       CASE WHEN cause = 'natural' THEN 'blue' ELSE 'red' END AS colour,
       printf('<b>Cause:</b> %s</br><b>Surface Temperature:</b> %d</br><b>Air Temperature:</b> %d</br><b>Relative Humidity:</b> %d',
              cause, CAST(trunc(surface_temperature_celcius) AS INTEGER),
              CAST(trunc(air_temperature_celcius) AS INTEGER),
              CAST(trunc(relative_humidity) AS INTEGER)) AS popup,
       confidence
FROM enriched WHERE time >= TIMESTAMP '2024-01-15 00:00:00'"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["climate_on_date"] = _with(CLIMATE) + f"""
SELECT {CLIMATE_COLS} FROM climate WHERE date = DATE '1998-12-12' LIMIT 1"""
    q["hotspots_by_surface_temp"] = _with(CLIMATE, HOTSPOT, FACTS) + """
SELECT latitude, longitude, surface_temperature_celcius, confidence FROM facts
WHERE surface_temperature_celcius BETWEEN 65 AND 100"""
    q["conditions_on_dates"] = _with(CLIMATE, HOTSPOT) + """
SELECT c.date, c.air_temperature_celcius, c.relative_humidity, c.max_wind_speed,
       h.surface_temperature_celcius
FROM climate c LEFT JOIN hotspot h ON c.date = h.date
WHERE c.date IN (DATE '1998-12-15', DATE '1998-12-16')"""
    q["hotspots_by_confidence"] = _with(CLIMATE, HOTSPOT, FACTS) + """
SELECT time, air_temperature_celcius, surface_temperature_celcius, confidence FROM facts
WHERE confidence BETWEEN 80 AND 100"""
    q["hottest_hotspots"] = _with(CLIMATE, HOTSPOT, FACTS) + f"""
SELECT {CLIMATE_COLS}, time, latitude, longitude, confidence, surface_temperature_celcius
FROM facts
ORDER BY surface_temperature_celcius DESC, {CLIMATE_COLS.replace(', ', ' ASC, ')} ASC,
         time, latitude, longitude, confidence
LIMIT 10"""
    q["fires_per_day"] = _with(CLIMATE, HOTSPOT) + """
SELECT strftime(c.date, '%d/%m/%Y') AS date, CAST(count(h.date) AS BIGINT) AS numberOfFires
FROM climate c LEFT JOIN hotspot h ON c.date = h.date GROUP BY c.date"""
    q["low_confidence_hotspots"] = _with(CLIMATE, HOTSPOT, FACTS) + """
SELECT time, latitude, longitude, confidence, surface_temperature_celcius FROM facts
WHERE confidence < 70"""
    q["avg_surface_temp_per_day"] = _with(CLIMATE, HOTSPOT, FACTS) + """
SELECT strftime(date, '%d/%m/%Y') AS date, avg(surface_temperature_celcius) AS avgTemp
FROM facts GROUP BY date"""
    q["lowest_ghi_days"] = _with(CLIMATE) + f"""
SELECT {CLIMATE_COLS} FROM climate ORDER BY ghi, date LIMIT 10"""
    q["days_by_precipitation"] = _with(CLIMATE) + f"""
SELECT {CLIMATE_COLS} FROM climate
WHERE precipitation_type = 'G' AND precipitation BETWEEN 0.20 AND 0.35"""
    q["load_climate_documents"] = _with(CLIMATE, HOTSPOT) + f"""
SELECT c.date, c.station, c.air_temperature_celcius, c.relative_humidity, c.windspeed_knots,
       c.max_wind_speed, c.precipitation, c.precipitation_type, c.ghi,
       h.time, h.latitude, h.longitude, h.confidence, h.surface_temperature_celcius
FROM climate c LEFT JOIN hotspot h ON c.date = h.date"""
    q["fires_per_day_documents"] = q["fires_per_day"]
    q["conditions_on_dates_documents"] = q["conditions_on_dates"]
    q["climate_on_date_documents"] = _with(CLIMATE, HOTSPOT) + """
SELECT c.date, c.station, c.air_temperature_celcius, c.relative_humidity, c.windspeed_knots,
       c.max_wind_speed, c.precipitation, c.precipitation_type, c.ghi,
       h.time, h.latitude, h.longitude, h.confidence, h.surface_temperature_celcius
FROM climate c LEFT JOIN hotspot h ON c.date = h.date
WHERE c.date = DATE '1998-12-12'"""
    q["hotspots_per_hour"] = _with(CLIMATE, HOTSPOT, FACTS) + """
SELECT CAST(r.range AS INTEGER) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hotspots
FROM range(24) r LEFT JOIN (
  SELECT hour(time) AS hour, count(*) AS n FROM facts GROUP BY 1) c ON r.range = c.hour"""
    q["pair_satellites"] = _with(_feed(), PAIRS) + """
SELECT batch, geo_cell, arrival, time, latitude, longitude, confidence,
       surface_temperature_celcius, satellite, merged FROM pairs"""
    q["latest_climate_per_batch"] = _with(_feed(), LATEST) + """
SELECT * FROM climate_batch"""
    q["enrich_climate"] = _with(_feed(), PAIRS, LATEST, ENRICHED) + """
SELECT * FROM enriched"""
    q["fire_markers"] = _with(_feed(), PAIRS, LATEST, ENRICHED) + MARKERS
    q["rolling_temperature_extremes"] = _with(_feed(), ROLLING) + """
SELECT stream, arrival, seq, day_label, temperature,
       lo.v AS min_value, lo.l AS min_label_at, hi.v AS max_value, hi.l AS max_label_at,
       'Minimum (Date: ' || lo.l || ' & Temp: ' || CAST(lo.v AS VARCHAR) || ')' AS min_caption,
       'Maximum (Date: ' || hi.l || ' & Temp: ' || CAST(hi.v AS VARCHAR) || ')' AS max_caption
FROM framed WHERE n = 11"""
    q["load_climate_documents_csv"] = q["load_climate_documents"]
    q["normalize_climate_feed"] = _with(_feed()) + f"""
SELECT latitude, longitude, air_temperature_celcius, relative_humidity, windspeed_knots,
       max_wind_speed, precipitation, precipitation_type, ghi
FROM feed WHERE producer_id = 'producer_climate'"""
    q["normalize_satellite_feed"] = _with(_feed()) + """
SELECT producer_id, latitude, longitude, confidence, surface_temperature_celcius
FROM feed WHERE producer_id IN ('producer_hotspot_aqua', 'producer_hotspot_terra')"""
    q["stream_event_time_enrichment"] = q["enrich_climate"]
    # The records sent after every window has closed are rejected.
    in_time = _feed(name="feed0") + ", feed AS (SELECT * FROM feed0 WHERE arrival % 97 <> 5)"
    q["stream_event_time_held_back"] = _with(in_time, PAIRS, LATEST, ENRICHED) + """
SELECT * FROM enriched"""
    q["stream_event_time_rejects"] = _with(_feed()) + """
SELECT CASE producer_id WHEN 'producer_climate' THEN 'Climate' WHEN 'producer_hotspot_aqua' THEN 'Hotspot_AQUA'
    ELSE 'Hotspot_TERRA' END AS topic, CAST(arrival AS BIGINT) AS "offset", 'late_window' AS reject_reason
FROM feed WHERE producer_id IS NOT NULL AND arrival % 97 = 5"""
    q["stream_rolling_extremes"] = q["rolling_temperature_extremes"]
    # Dealt over three source partitions; the events ascend with their time.
    q["stream_rolling_extremes_partitions"] = f"""
SELECT * REPLACE (arrival // 3 + arrival % 3 * {1 << 40} AS arrival) FROM ({q["rolling_temperature_extremes"]})"""
    q["load_rejects"] = _with(CLIMATE, HOTSPOT) + """
SELECT 'climate' AS file, CASE day(date) WHEN 13 THEN 'unreadable:relative_humidity' WHEN 15 THEN 'unreadable:date'
  ELSE 'loaded' END AS reject_reason, count(*) AS n FROM climate GROUP BY ALL
UNION ALL
SELECT 'hotspot', 'missing:time', count(*) FROM hotspot WHERE day(date) = 16 HAVING count(*) > 0"""
    q["message_rejects"] = _with(_feed()) + """
SELECT CASE producer_id WHEN 'producer_climate' THEN 'Climate' WHEN 'producer_hotspot_aqua' THEN 'Hotspot_AQUA'
    ELSE 'Hotspot_TERRA' END AS topic, CAST(arrival AS BIGINT) AS "offset",
  CASE arrival % 50 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'unknown_producer' WHEN 2 THEN 'no_measure'
    ELSE 'no_position' END AS reject_reason
FROM feed WHERE producer_id IS NOT NULL AND arrival % 50 < 4"""
    # The replay's batches: a fixed width of arrivals.
    by_width = _feed(name="feed0") + f""",
feed AS (
  SELECT * REPLACE (arrival // {BATCH_WIDTH} AS batch) FROM feed0 WHERE producer_id IS NOT NULL)"""
    q["stream_arrival_enrichment"] = _with(by_width, PAIRS, LATEST, ENRICHED) + """
SELECT * EXCLUDE (batch), batch AS batch_id FROM enriched"""
    q["stream_arrival_enrichment_split"] = q["stream_arrival_enrichment"]
    q["stream_arrival_enrichment_as_coded"] = _with(by_width, PAIRS_AS_CODED, LATEST,
                                                    ENRICHED) + """
SELECT * EXCLUDE (batch), batch AS batch_id FROM enriched"""
    q.update(collection_oracles(by_width))
    return q


def collection_oracles(feed: str) -> dict[str, str]:
    """The queries over the historic load and the arrival stream together:
    ``opened`` has a row a hotspot, or one for a record without any."""
    hot = "time, latitude, longitude, confidence, surface_temperature_celcius, cause"
    opened = f"""
opened AS (
  SELECT 'historic ' || c.date AS doc, c.*, h.* EXCLUDE (date), CAST(NULL AS VARCHAR) AS cause
  FROM climate c LEFT JOIN hotspot h ON c.date = h.date
  UNION ALL BY NAME
  SELECT 'stream ' || batch AS doc, {CLIMATE_COLS}, {hot} FROM enriched),
fires AS (SELECT * FROM opened WHERE time IS NOT NULL)"""
    model = _with(CLIMATE, HOTSPOT, feed, PAIRS, LATEST, ENRICHED, opened)
    whole = f"SELECT {CLIMATE_COLS}, {hot} FROM opened"
    order = f"surface_temperature_celcius DESC, {CLIMATE_COLS}, time, latitude, longitude, confidence, cause"
    answers = {
        "climate_on_date": f"{whole} WHERE date = DATE '1998-12-12'",
        "hotspots_by_surface_temp": "SELECT latitude, longitude, surface_temperature_celcius, confidence FROM fires "
                                    "WHERE surface_temperature_celcius BETWEEN 65 AND 100",
        "conditions_on_dates": "SELECT date, air_temperature_celcius, relative_humidity, max_wind_speed, surface_temperature_celcius "
                               "FROM opened WHERE date IN (DATE '1998-12-15', DATE '1998-12-16', DATE '2024-01-16')",
        "hotspots_by_confidence": "SELECT time, air_temperature_celcius, surface_temperature_celcius, confidence FROM fires "
                                  "WHERE confidence BETWEEN 80 AND 100",
        "hottest_hotspots": f"SELECT {CLIMATE_COLS}, {hot} FROM fires ORDER BY {order} LIMIT 10",
        "fires_per_day": "SELECT strftime(date, '%d/%m/%Y') AS date, CAST(count(time) AS BIGINT) AS numberOfFires "
                         "FROM opened GROUP BY doc, opened.date",
        "low_confidence_hotspots": f"SELECT {hot} FROM fires WHERE confidence < 70",
        "avg_surface_temp_per_day": "SELECT strftime(date, '%d/%m/%Y') AS date, avg(surface_temperature_celcius) AS avgTemp "
                                    "FROM fires GROUP BY fires.date",
        "lowest_ghi_days": f"{whole} WHERE doc IN (SELECT doc FROM opened GROUP BY doc ORDER BY min(ghi), min(date) LIMIT 10)",
        "days_by_precipitation": f"{whole} WHERE precipitation_type = 'G' AND precipitation BETWEEN 0.20 AND 0.35",
        "hotspots_per_hour": """
SELECT CAST(r.range AS INTEGER) AS hour, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hotspots
FROM range(24) r LEFT JOIN (SELECT hour(time) AS hour, count(*) AS n FROM fires GROUP BY 1) c ON r.range = c.hour""",
        "fire_markers": MARKERS.replace("enriched", "fires"),
    }
    return {f"collection_{name}": f"{model} {answer}" for name, answer in answers.items()}
