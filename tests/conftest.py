import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from merchlake import model  # noqa: E402
from merchlake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def work(tmp_path):
    return str(tmp_path)


def at(text):
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


CLEAN = {
    "customers": [
        ("CUST-1", "Alice Smith", "alice@example.com", at("2025-01-01 10:00:00"), "Web"),
        ("CUST-2", "Bob Jones", "bob@example.com", at("2025-01-02 23:00:00"), "Referral"),
    ],
    "products": [
        ("PROD-1", "Desk Lamp", "Home", 10.0, 5),
        ("PROD-2", "Yoga Mat", "Sports", 25.5, 0),
    ],
    "orders": [
        ("ORD-1", "CUST-1", "PROD-1", 2, 20.0, at("2025-02-01 09:00:00"), "Completed"),
        ("ORD-2", "CUST-1", "PROD-1", 1, 10.0, at("2025-03-08 01:00:00"), "Cancelled"),
    ],
    "payments": [
        ("PAY-1", "ORD-1", "UPI", 20.0, "Completed", at("2025-02-01 09:05:00")),
        ("PAY-2", "ORD-2", "PayPal", 10.0, "Refunded", at("2025-03-08 01:05:00")),
    ],
    "reviews": [
        ("REV-1", "CUST-1", "PROD-1", 5, "Works well", at("2025-04-01 00:00:00")),
        ("REV-2", "CUST-2", "PROD-1", 2, 'Said "no", twice', at("2025-04-02 00:00:00")),
    ],
}


def frames(spark, rows=CLEAN):
    return {
        name: spark.createDataFrame(rows[name], relation.schema)
        for name, relation in model.RELATIONS.items()
    }


@pytest.fixture
def tables(spark):
    return frames(spark)


@pytest.fixture
def empty_tables(spark):
    return frames(spark, {name: [] for name in model.RELATIONS})
