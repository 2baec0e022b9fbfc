import sys
from datetime import timedelta
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from sample_data import START  # noqa: E402
from tillwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_tx(spark):
    """Transactions from (user, amount, location, device[, minute]) tuples."""
    from tillwise.sources.feeds import TRANSACTIONS

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            user, amount, location, device = row[:4]
            minute = row[4] if len(row) > 4 else i
            full.append(
                (i, user, amount, location, device, START + timedelta(minutes=minute), i % 2)
            )
        return spark.createDataFrame(full, TRANSACTIONS)

    return make
