"""Driver contract and pipeline properties."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from mdquarry.operators import responses as rs
from mdquarry.sources.tables import TABLES

from .conftest import SF_SMALL


def test_every_query_has_oracle():
    assert set(entry_mod.QUERIES) == set(entry_mod.oracle_queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert len(entry_mod.QUERIES) >= 30


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and "record_md5" in df.columns


@pytest.mark.parametrize("name", ["sections", "request_grid", "section_neighbours", "type_stats"])
def test_oracle_matches_on_small_data(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(entry_mod.oracle_sql()[name])
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    assert sorted(rel.columns) == sorted(sdf.columns)
    cols = sorted(sdf.columns)
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=repr)
    assert got == want


def test_ranks_are_gapless(small_corpus):
    n = small_corpus.section_neighbours
    g = n.groupBy("doc_id", "section_idx").agg(F.max("rank").alias("m"), F.count("*").alias("c"))
    assert g.where("m <> c").count() == 0


def test_units_end_exactly_once(small_corpus):
    """Every unit either succeeds once or is still failing; train + eval = records."""
    c = small_corpus
    units = c.request_keys.select(*rs.UNIT).distinct().count()
    ok = c.firsts.where("first_ok IS NOT NULL").count()
    still = rs.still_failing(c.outcomes, c.firsts).count()
    assert ok + still == units
    counts = c.records.groupBy("split").count().collect()
    assert sum(r["count"] for r in counts) == c.records.count()
    assert c.qa.count() == c.records.count() + c.quarantine.count()


def test_entry_imports_outside_the_repo_and_kernels_reach_the_workers(tmp_path):
    """No session, no PYTHONPATH and another working directory; the workers cannot import the package."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
from mdquarry.session import local_session
spark = local_session(2)
print("ROWS", e.queries()["section_neighbours"](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1]) > 0
