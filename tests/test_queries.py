"""Registered queries against their SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES
from emberline.plans import queries
from emberline.plans.oracle import oracle
from emberline.plans.queries import registered
from emberline.schemas import SILVER
from emberline.sinks.tables import write_days

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(registered()) == set(oracle())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_stay_without_a_library_of_the_optional_part():
    """A module that cannot be imported takes the optional queries away, and no other."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    names, sql = (set(line.split()) for line in done.stdout.splitlines()[-2:])
    assert names == set(registered()) and sql == set(oracle())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, engine, name):
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = sorted(tuple(map(str, r)) for r in found.select(*columns).collect())
    wanted = engine.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(map(str, r)) for r in wanted) == rows


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_the_stored_stream_table_is_compressed_by_zstandard(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = spark.sql("SELECT 'a' AS id, date'2024-01-30' AS processing_date")
    monkeypatch.setattr(queries.testbed, "silver", lambda spark, sf_dir: rows)
    monkeypatch.setattr(queries, "stored_days", lambda spark, path, schema: spark.read.parquet(path))
    assert queries.silver_days(spark, "").count() == 1
    assert [".zstd." in f.name for f in tmp_path.rglob("part-*")] == [True]


def test_scores_of_the_whole_history_send_no_text(spark, monkeypatch):
    """The length of the cleaned text is taken ahead of the merge's exchange, behind which nothing is cleaned."""
    staged = []
    monkeypatch.setattr(queries, "stage", lambda df, name: staged.append(df) or df)
    assert queries.viral_scores_all(spark, SF_DIR).columns[0] == "id"
    behind, _, ahead = staged[0]._jdf.queryExecution().executedPlan().toString().partition("Exchange hashpartitioning(id")
    assert "regexp_replace" in ahead and "regexp_replace" not in behind and "selftext" not in behind


def test_the_extraction_reads_a_stream_table_written_unsorted(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "write_days", lambda df, path: written.append(path) or write_days(df, path))
    assert spark.read.parquet(queries.stored_gold(spark, SF_DIR)).count() > 0
    assert len(written) == 1 and spark.read.schema(SILVER).parquet(written[0]).count() > 0
