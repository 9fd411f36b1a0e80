from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from litweft.session import get_session

    shared = tmp_path_factory.mktemp("shared")
    s = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(shared), "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(df):
    """Sorted plain tuples of a DataFrame."""
    return sorted((plain(tuple(r)) for r in df.collect()), key=repr)


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return round(v, 6) if isinstance(v, float) else v


def same(df, rel) -> None:
    """A Spark result equals a DuckDB result, columns by name, rows in any order."""
    assert sorted(df.columns) == sorted(rel.columns)
    pick = lambda cols: [cols.index(c) for c in sorted(cols)]
    a, b = pick(df.columns), pick(rel.columns)
    got = sorted((tuple(plain(r[i]) for i in a) for r in map(tuple, df.collect())), key=repr)
    want = sorted((tuple(plain(r[i]) for i in b) for r in rel.fetchall()), key=repr)
    assert got == want
