"""Every registered query against its SQL, over whole tables."""

import os
import subprocess
import sys

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from catalogue.oracle import ORACLE as SQL
from catalogue.queries import QUERIES

SMOKE = entry_point.SMOKE_DIR


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10


def test_entry_needs_no_working_folder(tmp_path):
    """Readers run in Python workers; none finds the repository by itself here."""
    code = f"""
import sys; sys.path.insert(0, {str(entry_point.ROOT)!r})
import __spark_entry__ as e
from stationflow import build_session
spark = build_session("far", "local[2]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
names = [n for n in e.queries() if n in ("trips_archive_results", "op3_html")]
print("rows", [e.queries()[n](spark, {SMOKE!r}).count() for n in names])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows [1" in out.stdout, out.stderr[-2000:]


def test_entry_registers_the_catalogue():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert SQL.items() <= entry_point.oracle_sql().items()


@pytest.mark.parametrize(
    "sf_name, raw, clean, staged, cells, mart",
    [("0.001", 6000, 5714, 5298, 213, 1107), ("0.01", 60000, 57143, 53479, 1974, 14755)],
)
def test_funnel(spark, sf_name, raw, clean, staged, cells, mart):
    from catalogue import queries as q
    from stationflow import fixtures as fx

    folder = f"/root/testdata/sf{sf_name}"
    found = (
        fx.trips_raw(spark, folder).count(),
        q.clean(spark, folder).count(),
        q.staged_trips(spark, folder).count(),
        q.hourly_supply(spark, folder).count(),
        q.scored(spark, folder).count(),
    )
    assert found == (raw, clean, staged, cells, mart)
