import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    """A value as both engines would write it."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, dict):
        value = list(value.values())
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    if value is None or value != value:
        return "NULL"
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    return str(value)


def compared(spark, query, sql, folder=DATA):
    """Sorted rows of a query and of its SQL, columns in the order of their names."""
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = query(spark, folder)
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    rows = lambda data, cols: sorted(tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in data)
    return rows([tuple(r) for r in df.collect()], df.columns), rows(expected.fetchall(), names)
