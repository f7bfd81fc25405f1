import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from data_paths import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pairgrade import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="pairgrade-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pairgrade-test-")


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("part", "orders", "lineitem", "region", "nation", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
