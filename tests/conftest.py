import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tessera.session import configure

    s = (SparkSession.builder.master("local[*]").appName("tessera-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    from tessera.session import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
