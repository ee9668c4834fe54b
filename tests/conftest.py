from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starweave.session import local_session  # noqa: E402
from starweave.sources.schemas import struct_type  # noqa: E402

TESTDATA = "/root/testdata"
SF_SMALL = f"{TESTDATA}/sf0.001"
SF_MEDIUM = f"{TESTDATA}/sf0.01"

RAW_FIELDS = struct_type("orders", drop=("row_id",)).fieldNames()


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="starweave-tests-")
    s = local_session(4, shuffle_partitions=8, scratch=scratch, app="starweave-tests")
    yield s
    s.stop()


def raw_row(**kw):
    """One raw order line with defaults; override any column by keyword."""
    row = {
        "order_id": "O1",
        "order_date": dt.date(2020, 1, 1),
        "ship_date": dt.date(2020, 1, 3),
        "ship_mode": "Standard",
        "customer_id": "C1",
        "customer_name": "Ann",
        "segment": "Consumer",
        "country": "US",
        "city": "Springfield",
        "state": "IL",
        "postal_code": "62701",
        "region": "Central",
        "product_id": "P1",
        "category": "Office",
        "subcategory": "Paper",
        "product_name": "Copy paper",
        "sales": decimal.Decimal("10.0000"),
        "quantity": 1,
        "discount": decimal.Decimal("0.00"),
        "profit": decimal.Decimal("1.0000000000000000"),
    }
    row.update(kw)
    return tuple(row[f] for f in RAW_FIELDS)


def raw_frame(spark, rows, partitions: int | None = None):
    df = spark.createDataFrame(rows, struct_type("orders", drop=("row_id",)))
    return df.repartition(partitions) if partitions else df
