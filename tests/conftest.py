import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tillworks.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def sale(spark):
    """Builder of raw lines: a sound line with some fields replaced."""
    from tillworks.schemas import REQUIRED_FIELDS

    sound = {
        "transaction_id": "t1",
        "product_id": "p1",
        "product_name": "milk",
        "category": "dairy",
        "quantity": "2",
        "unit_price": "1.50",
        "total_price": "3.00",
        "timestamp": "2026-01-22T08:45:58.232187+00:00",
        "store_id": "north_01",
        "payment_method": "cash",
        "client_type": "regular",
    }

    def build(*changes):
        rows = [tuple({**sound, **change}[f] for f in REQUIRED_FIELDS) for change in changes]
        return spark.createDataFrame(rows, ", ".join(f"`{f}` string" for f in REQUIRED_FIELDS))

    build.sound = sound
    return build
