import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from tessella.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, **{"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for p in os.listdir(data):
        con.sql(f"CREATE VIEW {p.split('.')[0]} AS SELECT * FROM read_parquet('{data}/{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, duck, sql):
    cols = sorted(df.columns)
    got = sorted(repr(tuple(plain(x) for x in r)) for r in df.select(*cols).collect())
    want = sorted(repr(tuple(plain(x) for x in r)) for r in duck.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())
    assert got == want
