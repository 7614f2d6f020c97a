"""Every registered query against its SQL twin in DuckDB, at the smallest scale."""

import datetime
import decimal
import math

import duckdb
import pytest

from spindlekg.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else value


def rows(found, columns):
    return sorted(repr(tuple(plain(r[c]) for c in sorted(columns))) for r in found)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_oracle(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = [r.asDict() for r in df.collect()]
    assert got
    assert rows(got, df.columns) == rows([dict(zip(want.columns, r, strict=True)) for r in want.fetchall()], df.columns)


def test_the_summary_of_many_kinds_equals_its_oracle(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * REPLACE (CASE WHEN event_id % 4 = 0 THEN event_type ELSE 'kind ' || CAST(event_id % 230 AS VARCHAR) END AS event_type) FROM '{DATA}/events.parquet') TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    (tmp_path / "lineitem.parquet").symlink_to(f"{DATA}/lineitem.parquet")
    for t in ("events", "lineitem"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = registry.queries()["a7_kg_summary"](spark, str(tmp_path))
    want = con.sql(registry.oracle_sql()["a7_kg_summary"])
    assert df.columns == want.columns
    found = df.first()
    assert [tuple(found)] == want.fetchall()
    kinds = {line.split(":")[0].strip(): n for line, n in con.sql("SELECT CASE event_type WHEN 'error' THEN 'LLM调用失败' WHEN 'purchase' THEN 'ParseError' WHEN 'click' THEN '' ELSE event_type END, count(*) FROM events GROUP BY 1").fetchall()}
    assert len(kinds) > 200 and found.errors == ";".join(f"{k}={n}" for k, n in sorted(kinds.items(), key=lambda x: x[0].encode()))
