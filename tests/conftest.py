import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", "/tmp/runnel-test-warehouse").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def canonical(rows, columns):
    """Rows as sorted tuples of text, numbers alike whatever their width."""

    def one(v):
        if v is None or isinstance(v, float) and v != v:
            return "NULL"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    return sorted(tuple(one(r[c]) for c in sorted(columns)) for r in rows)


@pytest.fixture(scope="session")
def matches(spark, duck, sf_dir):
    """Fails unless a query's rows are those of its SQL."""

    def run(query, sql):
        df = query(spark, sf_dir)
        got = [r.asDict() for r in df.collect()]
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        want = [dict(zip(names, r, strict=True)) for r in cur.fetchall()]
        assert sorted(df.columns) == sorted(names)
        assert canonical(got, names) == canonical(want, names)

    return run
