from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def compare(spark):
    """Runs a query and its SQL on the small tables and compares rows."""
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{SMALL}/{t}.parquet'")

    def norm(d: pd.DataFrame) -> list[tuple]:
        d = d[sorted(d.columns)]

        def plain(v):
            if pd.isna(v):
                return None
            if isinstance(v, bool) or type(v).__name__ == "bool_":
                return bool(v)
            if hasattr(v, "__float__") and not isinstance(v, str):
                return round(float(v), 4) + 0.0
            return str(v)

        return sorted((tuple(map(plain, r)) for r in d.itertuples(index=False)), key=repr)

    def run(df, sql: str) -> None:
        got, want = df.toPandas(), con.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert norm(got) == norm(want)

    return run
