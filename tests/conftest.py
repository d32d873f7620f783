from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kiln_paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from kiln.session import local_session
    ckpt = tempfile.mkdtemp(prefix="kiln-test-ckpt-")
    s = local_session("*", 8, app="kiln-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from kiln.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="kiln-test-")
