import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    session = local_session(cores=4, partitions=4, memory="2g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    """DuckDB with the driver's tables as views."""
    import duckdb

    connection = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.fixture
def texts(spark):
    """Documents (document_id, text) from Python strings."""
    return lambda *values: spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "document_id string, text string")
