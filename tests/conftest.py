from __future__ import annotations

import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retinue.session import build_session  # noqa: E402
from retinue.sources.schemas import TABLES  # noqa: E402
from shop import Shop  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def model(spark):
    """Builds the eight tables from short row dicts; anything not given is NULL or empty."""

    def convert(value, kind):
        if isinstance(kind, T.DecimalType) and value is not None:
            return Decimal(str(value))
        if isinstance(kind, T.TimestampNTZType) and isinstance(value, str):
            return datetime.fromisoformat(value)
        return value

    def build(**rows):
        tables = {}
        for name, spec in TABLES.items():
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema.fields])
            data = [
                tuple(convert(row.get(f.name), f.dataType) for f in schema.fields)
                for row in rows.get(name, [])
            ]
            tables[name] = spark.createDataFrame(data, schema)
        return tables

    return build


@pytest.fixture
def shop():
    return Shop()
