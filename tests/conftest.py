import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    c = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        c.sql(f"create view {f.stem} as select * from read_parquet('{f}')")
    return c
