from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from txnmart.schemas import SOURCE_FIELDS  # noqa: E402
from txnmart.session import local_session, shared_dir  # noqa: E402

AS_OF = "2026-06-01 00:00:00"
SMALL = Path("/root/testdata/sf0.001")

GOOD = {
    "transaction_id": "T1",
    "order_timestamp": "2026-01-05 10:00:00",
    "channel": "web",
    "product_category": "home",
    "quantity": "2",
    "amount": "10.00",
    "payment_method": "card",
    "customer_id": "C1",
    "status": "completed",
}


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Build raw rows: each argument overrides fields of one good row."""

    def build(*changes: dict):
        rows = []
        for number, change in enumerate(changes, start=1):
            row = {**GOOD, "raw_row_id": number, **change}
            rows.append(tuple(row[name] for name in ["raw_row_id", *SOURCE_FIELDS]))
        columns = ", ".join(f"{name} string" for name in SOURCE_FIELDS)
        return spark.createDataFrame(rows, f"raw_row_id long, {columns}")

    return build


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
