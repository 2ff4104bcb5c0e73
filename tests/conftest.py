import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# also for the Python workers
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from cardwatch.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 4, **{
        "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def medium_tx(spark):
    from cardwatch.sources.tables import transactions
    return transactions(spark, MEDIUM)


DEFAULTS = {
    "transaction_id": "TX1-1", "customer_id": "CUST1", "merchant_id": "MERCH1", "amount": 10.0, "currency": "EUR",
    "transaction_type": "PURCHASE", "channel": "ONLINE", "location": "Paris", "device_id": None, "ip_address": None,
    "timestamp_ms": 0, "card_type": "CREDIT", "is_international": False, "merchant_category": "RETAIL",
    "previous_balance": 100.0, "is_fraud": False,
}


@pytest.fixture(scope="session")
def make(spark):
    """Rows from a few given fields; ids and times count up where they are not given."""
    from pyspark.sql.types import StructField, StructType

    from cardwatch.schemas import TRANSACTION
    from cardwatch.sources.readers import from_rows

    nullable = StructType([StructField(f.name, f.dataType) for f in TRANSACTION])

    def build(*rows: dict):
        full = [{**DEFAULTS, "transaction_id": f"TX{i}-{i}", **row} for i, row in enumerate(rows, 1)]
        return from_rows(spark, [tuple(r[f.name] for f in TRANSACTION) for r in full], nullable)

    return build


def values(df, *columns, order="transaction_id"):
    rows = df.orderBy(order).select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in rows]
