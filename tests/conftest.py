import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from basketlens.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="basketlens-tests")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def at():
    """Timestamp of a day number after 2020-01-01 and an hour."""
    return lambda day, hour=0: datetime.datetime(2020, 1, 1) + datetime.timedelta(days=day, hours=hour)


INVOICES = "invoice_no string, customer_id bigint, invoice_date timestamp_ntz, is_cancellation boolean"
ITEMS = "invoice_no string, stock_code string, quantity int, unit_price decimal(12,4), line_total decimal(14,4)"


@pytest.fixture(scope="session")
def shop(spark):
    """Build (invoices, items) from (invoice, customer, timestamp, [line totals]) tuples; a C prefix cancels."""
    from decimal import Decimal

    def build(rows):
        invoices = [(no, customer, when, no.startswith("C")) for no, customer, when, _ in rows]
        items = [(no, "p", 1, Decimal(str(x)), Decimal(str(x))) for no, _, _, lines in rows for x in lines]
        return spark.createDataFrame(invoices, INVOICES), spark.createDataFrame(items, ITEMS)
    return build
