"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("WEFTLINE_TEST_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    values = [tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r)
              for r in plain.itertuples(index=False, name=None)]
    return columns, sorted(values, key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = rows(entry.queries()[name](spark, FOLDER).toPandas())
    assert got == rows(db.sql(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


STREAMS = ["stream_ingest_clean", "stream_dedup", "periodic_flush", "stream_metrics_window"]


@pytest.mark.parametrize("name", STREAMS)
def test_streams_read_folders_of_parts(spark, db, tmp_path, name):
    for table in ("documents", "events"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    got = rows(entry.queries()[name](spark, str(tmp_path)).toPandas())
    assert got == rows(db.sql(entry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", STREAMS)
def test_streams_of_empty_tables(spark, tmp_path, name):
    for table in ("documents", "events"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert entry.queries()[name](spark, str(tmp_path)).count() == 0
