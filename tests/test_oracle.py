"""The registered queries against their DuckDB oracles, and the entry smoke check."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

STREAMS = ("stream_event_time_enrichment", "stream_event_time_held_back", "stream_rolling_extremes", "stream_arrival_enrichment")


def test_every_query_has_an_oracle():
    assert set(E.reference_queries()) <= set(E.oracle_sql())


def test_batch_queries_match_oracle(spark):
    names = [n for n in E.reference_queries() if n not in STREAMS]
    assert compare(spark, SF_SMALL, names=names, verbose=False) == []


def test_arrival_stream_matches_oracle(spark):
    assert compare(spark, SF_SMALL, names=("stream_arrival_enrichment",), verbose=False) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["batch", "date"]
    assert df.count() > 0


def test_modules_import_without_a_session():
    """The driver may import the entry module before any session exists."""
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', %r); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); import emberlake.cli; print(len(m.queries()))"
            % os.path.join(root, "__spark_entry__.py"))
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split()[-1]) == len(E.queries())


def test_entry_works_without_the_optional_subpackage():
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r); sys.modules['emberlake.llm'] = None; import __spark_entry__ as e; "
            "assert set(e.queries()) == set(e.reference_queries()); print(len(e.oracle_sql()))" % root)
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
