"""Command line: load, query, stream and report.

Run as ``python -m emberlake.cli ...`` or
``spark-submit --py-files emberlake.zip emberlake/cli.py ...``:

  load --climate-csv C --hotspot-csv H (--out DOCS | --collection DOCS) [--rejects R]
  query hottest_hotspots --documents DOCS [--k 10] [--out OUT]
  stream (--records DIR | --kafka HOSTS) (--sink S | --collection DOCS) --checkpoint CK
         [--event-time] [--as-coded --batch-width N] [--flat] [--seconds 600]
  rolling (--records DIR | --kafka HOSTS) --sink S --checkpoint CK
  report hours|markers --documents DOCS [--out OUT]

Results go to Parquet with ``--out``; without it the first rows are shown.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from emberlake import schema as S
from emberlake.plans import documents as D
from emberlake.plans.load import load_climate_documents
from emberlake.session import build_session
from emberlake.sources.collection import DocumentCollection, read_documents
from emberlake.sources.messages import read_records_stream
from emberlake.streaming.enrich import (
    run_for, start_arrival_enrichment, start_event_time_enrichment,
)
from emberlake.streaming.rolling import start_rolling_extremes


def _or(value, default):
    """An option's value; zero is a value."""
    return default if value is None else value


QUERIES = {
    "climate_on_date": lambda docs, a: D.climate_on_date(docs, a.day or "2018-12-12"),
    "hotspots_by_surface_temp": lambda docs, a: D.hotspots_by_surface_temp(docs, _or(a.low, 65), _or(a.high, 100)),
    "conditions_on_dates": lambda docs, a: D.conditions_on_dates(docs, tuple(a.days or ("2018-12-15", "2018-12-16"))),
    "hotspots_by_confidence": lambda docs, a: D.hotspots_by_confidence(docs, _or(a.low, 80), _or(a.high, 100)),
    "hottest_hotspots": lambda docs, a: D.hottest_hotspots(docs, _or(a.k, 10)),
    "fires_per_day": lambda docs, a: D.fires_per_day(docs),
    "low_confidence_hotspots": lambda docs, a: D.low_confidence_hotspots(docs, _or(a.high, 70)),
    "avg_surface_temp_per_day": lambda docs, a: D.avg_surface_temp_per_day(docs),
    "lowest_ghi_days": lambda docs, a: D.lowest_ghi_days(docs, _or(a.k, 10)),
    "days_by_precipitation": lambda docs, a: D.days_by_precipitation(
        docs, a.kind or "G", _or(a.low, 0.20), _or(a.high, 0.35)),
}


def _emit(df: DataFrame, out: str | None) -> None:
    if out:
        df.write.mode("overwrite").parquet(out)
    else:
        df.show(20, truncate=False)


def _records(spark, a):
    options = {"kafka.fetch.max.bytes": str(a.fetch_bytes), "kafka.max.partition.fetch.bytes": str(a.fetch_bytes)}
    if a.group_id:
        options["kafka.group.id"] = a.group_id
    return read_records_stream(spark, a.records, kafka_servers=a.kafka, starting=a.starting,
                               max_per_trigger=a.max_per_trigger, kafka_options=options)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="emberlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--climate-csv", required=True)
    ld.add_argument("--hotspot-csv", required=True)
    to = ld.add_mutually_exclusive_group(required=True)
    to.add_argument("--out")
    to.add_argument("--collection")
    ld.add_argument("--rejects")
    q = sub.add_parser("query")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("--documents", required=True)
    q.add_argument("--out")
    q.add_argument("--day")
    q.add_argument("--days", nargs="*")
    q.add_argument("--low", type=float)
    q.add_argument("--high", type=float)
    q.add_argument("--k", type=int)
    q.add_argument("--kind")
    for name in ("stream", "rolling"):
        s = sub.add_parser(name)
        s.add_argument("--records")
        s.add_argument("--kafka")
        s.add_argument("--starting", default="latest" if name == "stream" else "earliest")
        s.add_argument("--max-per-trigger", type=int)
        s.add_argument("--fetch-bytes", type=int, default=15_728_640)
        s.add_argument("--group-id")
        s.add_argument("--sink", required=name == "rolling")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--seconds", type=float, default=600)
        s.add_argument("--trigger", default="10 seconds")
        if name == "stream":
            s.add_argument("--event-time", action="store_true")
            s.add_argument("--window", default="1 hour")
            s.add_argument("--delay", default="10 minutes")
            s.add_argument("--as-coded", action="store_true")
            s.add_argument("--batch-width", type=int)
            s.add_argument("--flat", action="store_true")
            s.add_argument("--collection")
            s.add_argument("--rejects")
    r = sub.add_parser("report")
    r.add_argument("which", choices=["hours", "markers"])
    r.add_argument("--documents", required=True)
    r.add_argument("--out")
    a = p.parse_args(argv)

    spark = build_session()
    if a.cmd == "load":
        target = {"collection": DocumentCollection(spark, a.collection)} if a.collection else {"out_path": a.out}
        load_climate_documents(spark, a.climate_csv, a.hotspot_csv, rejects_path=a.rejects, **target)
    elif a.cmd == "query":
        _emit(QUERIES[a.name](read_documents(spark, a.documents), a), a.out)
    elif a.cmd == "report":
        docs = read_documents(spark, a.documents)
        _emit(D.hotspots_per_hour(docs) if a.which == "hours" else D.fire_markers(docs), a.out)
    elif a.cmd == "stream":
        recs = _records(spark, a)
        if not a.sink and not a.collection:
            p.error("stream needs --sink or --collection")
        into = DocumentCollection(spark, a.collection) if a.collection else None
        if a.event_time:
            qs = [start_event_time_enrichment(recs, a.sink, a.checkpoint, a.window, a.delay, processing_time=a.trigger,
                                              rejects_path=a.rejects, nested=not a.flat, collection=into)]
        else:
            qs = [start_arrival_enrichment(recs, a.sink, a.checkpoint, rejects_path=a.rejects,
                                           processing_time=a.trigger, as_coded=a.as_coded,
                                           batch_width=a.batch_width, nested=not a.flat, collection=into)]
        run_for(qs, a.seconds)
    elif a.cmd == "rolling":
        recs = _records(spark, a)
        recs = recs.where(recs.topic == S.TOPIC_CLIMATE)
        run_for(start_rolling_extremes(recs, a.sink, a.checkpoint, processing_time=a.trigger), a.seconds)


if __name__ == "__main__":
    main()
