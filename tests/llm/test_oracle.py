import duckdb
import pytest

from emberline.llm.oracle import ORACLE
from emberline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    wanted = engine.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in found.select(*columns).collect())
