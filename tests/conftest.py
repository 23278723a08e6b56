"""One local session for all tests."""

import logging
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    logging.getLogger("py4j").setLevel(logging.ERROR)
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g")
        .config("spark.checkpoint.dir", str(root / "shared")).config("spark.sql.warehouse.dir", str(root / "warehouse")).getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """The value of a column expression over one row of the given columns."""
    from pyspark.sql import functions as F

    def of(build, *items, kind="string"):
        df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("x"))).collect()]

    return of
