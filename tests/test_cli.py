"""The command line over a loaded documents table."""

import os

from emberlake import cli
from emberlake.plans.warehouse import from_documents

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def test_load_then_query_and_report(spark, tmp_dir):
    docs = f"{tmp_dir}/docs"
    cli.main(["load", "--climate-csv", f"{FIX}/climate_small.csv",
              "--hotspot-csv", f"{FIX}/hotspot_small.csv", "--out", docs, "--rejects", f"{tmp_dir}/bad"])
    climate, facts = from_documents(spark.read.parquet(docs))
    assert climate.count() == 3 and facts.count() == 3
    assert "climate" in {r.file for r in spark.read.parquet(f"{tmp_dir}/bad").collect()}
    cli.main(["query", "hottest_hotspots", "--documents", docs, "--k", "2", "--out", f"{tmp_dir}/e"])
    top = [r.surface_temperature_celcius for r in spark.read.parquet(f"{tmp_dir}/e").collect()]
    assert sorted(top, reverse=True) == [72.0, 68.0]
    cli.main(["report", "hours", "--documents", docs, "--out", f"{tmp_dir}/h"])
    assert spark.read.parquet(f"{tmp_dir}/h").count() == 24


def test_stored_documents_push_date_filters(spark, tmp_dir):
    import contextlib
    import io

    from emberlake.plans.documents import climate_on_date
    docs = f"{tmp_dir}/docs"
    cli.main(["load", "--climate-csv", f"{FIX}/climate_small.csv",
              "--hotspot-csv", f"{FIX}/hotspot_small.csv", "--out", docs, "--rejects", f"{tmp_dir}/bad"])
    q = climate_on_date(spark.read.parquet(docs), "2018-03-05")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    assert "PushedFilters: [IsNotNull(date), EqualTo(date,2018-03-05)]" in buf.getvalue()
    assert len(q.collect()[0].hotspots) == 2


def test_zero_is_an_option_value(spark, tmp_dir):
    docs = f"{tmp_dir}/docs"
    cli.main(["load", "--climate-csv", f"{FIX}/climate_small.csv",
              "--hotspot-csv", f"{FIX}/hotspot_small.csv", "--out", docs, "--rejects", f"{tmp_dir}/bad"])
    cli.main(["query", "hotspots_by_surface_temp", "--documents", docs, "--low", "0", "--high", "70", "--out", f"{tmp_dir}/b"])
    got = [r.surface_temperature_celcius for r in spark.read.parquet(f"{tmp_dir}/b").collect()]
    assert got and max(got) <= 70
    cli.main(["query", "hottest_hotspots", "--documents", docs, "--k", "0", "--out", f"{tmp_dir}/k"])
    assert spark.read.parquet(f"{tmp_dir}/k").count() == 0
