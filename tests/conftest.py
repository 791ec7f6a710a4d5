import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    own = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", str(own / "local"))
        .config("spark.checkpoint.dir", str(own / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(own / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(DATA).exists():
        pytest.skip("the driver's tables are not here")
    return DATA


def normal(value):
    """A value as both engines can be compared."""
    import numpy as np
    import pandas as pd

    if value is None or value is pd.NA or value != value:
        return None
    if isinstance(value, bool | np.bool_):
        return bool(value)
    if isinstance(value, int | np.integer):
        return int(value)
    if isinstance(value, float | np.floating):
        return int(value) if float(value).is_integer() else round(float(value), 9)
    return str(value)


def rows_of(pdf):
    columns = sorted(pdf.columns)
    rows = (tuple(normal(v) for v in r) for r in pdf[columns].itertuples(index=False, name=None))
    return columns, sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir, duck):
    def check(query, sql):
        mine, theirs = rows_of(query(spark, sf_dir).toPandas()), rows_of(duck.sql(sql).df())
        assert mine[0] == theirs[0]
        assert mine[1] == theirs[1]
        assert mine[1]

    return check
