import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def same_as_sql(got, sql, sf=SF):
    """Whether a result holds the same rows as DuckDB's, columns by name, in any order."""
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    want = c.sql(sql)
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    norm = lambda v: int(v) if isinstance(v, float) and v.is_integer() else v
    key = lambda rs: sorted((tuple(norm(v) for v in r) for r in rs), key=repr)
    a = key(tuple(r[c] for c in columns) for r in got.collect())
    b = key(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert a == b
