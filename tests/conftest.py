import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tollgate.session import local_session  # noqa: E402

ROW_SCHEMA = (
    "transaction_id string, account_id string, api_key_id string, event_time bigint, "
    "amount decimal(18,4), source_partition int, source_offset bigint"
)


@pytest.fixture(scope="session")
def spark():
    return local_session("8", 4)


@pytest.fixture
def rows(spark):
    """Build rows from (account, api key, event time, amount), in arrival order."""

    def build(items):
        data = [
            (f"t{i}", account, key, time, Decimal(str(amount)), 0, i)
            for i, (account, key, time, amount) in enumerate(items)
        ]
        return spark.createDataFrame(data, ROW_SCHEMA)

    return build
