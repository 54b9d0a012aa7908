import os
import sys
from datetime import UTC, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

T0 = datetime(2026, 8, 10, tzinfo=UTC)  # a Monday


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from candlewick.session import get_session

    s = get_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def row(i, o="1.17", h=None, low=None, c=None, v="100", symbol="EUR/USD", start=T0, step=timedelta(minutes=1)):
    o = Decimal(o)
    c = Decimal(c) if c else o
    return (start + i * step, symbol, o, Decimal(h) if h else max(o, c) + Decimal("0.0005"), Decimal(low) if low else min(o, c) - Decimal("0.0005"), c, Decimal(v))


@pytest.fixture
def candles(spark):
    from candlewick.schema import CANDLE

    def make(rows):
        return spark.createDataFrame(list(rows), CANDLE)

    return make
