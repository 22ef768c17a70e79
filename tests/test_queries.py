"""Registered queries against their SQL on the smallest tables, and the contract of the entry module."""

import importlib
import math
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from streamalign.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def shown(v):
    return ("nan" if math.isnan(v) else repr(round(v, 9))) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = sorted(tuple(shown(x) for x in r) for r in df.select(*sorted(df.columns)).collect())
    cur = con.execute(ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(tuple(shown(r[names.index(c)]) for c in sorted(names)) for r in cur.fetchall())
    assert got == expected and got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


def test_entry_without_the_optional_parts(monkeypatch):
    monkeypatch.setitem(sys.modules, "streamalign.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "streamalign.llm.queries", None)
    fresh = importlib.reload(entry)
    try:
        assert set(fresh.queries()) == set(QUERIES)
    finally:
        monkeypatch.undo()
        importlib.reload(entry)


def test_ranges_of_repartitioned_input(spark):
    from streamalign.operators import edges
    from streamalign.plans import views

    s = views.samples(spark, SF)
    a = sorted(map(tuple, edges.rising_edges(s, ["session"]).collect()))
    b = sorted(map(tuple, edges.rising_edges(s.repartition(7), ["session"], width=13).collect()))
    assert a == b


def test_all_cells_and_planes(spark):
    from streamalign.plans import views

    planes = {x.plane for x in views.traces(spark, SF).select("plane").distinct().collect()}
    assert len(planes) > 2
    cells = QUERIES["g5_upsample_cells"](spark, SF).select("plane", "roi").distinct().collect()
    assert {x.plane for x in cells} == planes and len({x.roi for x in cells}) > 1
    for name in ("a7_peri_event_z_planes", "g3_align_trace_planes"):
        assert {x.plane for x in QUERIES[name](spark, SF).select("plane").distinct().collect()} == planes
