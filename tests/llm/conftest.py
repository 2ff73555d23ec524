from __future__ import annotations

import os

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{SMALL}/{name}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


@pytest.fixture(scope="session")
def small():
    return SMALL
