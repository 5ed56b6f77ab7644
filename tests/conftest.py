import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def normal(v):
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v)


def same_rows(spark, con, make, sql, sf):
    df = make(spark, sf)
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    want = sorted(tuple(normal(r[names.index(c)]) for c in cols) for r in got.fetchall())
    assert sorted(tuple(normal(r[c]) for c in cols) for r in df.collect()) == want


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con
