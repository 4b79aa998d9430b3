import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from txnlens.plans.tables import Tables

    return Tables(spark, SF)


def same_rows(a, b, places=9):
    """Two frames hold the same rows, doubles compared after rounding."""
    from txnlens.functions.output import rounded

    a, b = rounded(a, places), rounded(b.select(*a.columns), places)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
