from __future__ import annotations

import sys
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyhouse.schemas import TABLES  # noqa: E402
from tallyhouse.session import get_session  # noqa: E402

DEFAULTS = {
    "bigint": 1,
    "int": 1,
    "string": "x",
    "boolean": True,
    "date": date(2024, 1, 1),
    "timestamp_ntz": datetime(2024, 1, 1),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", cores="4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """A source table from partial rows: required columns get a default, others NULL."""

    def build(name: str, *rows: dict):
        schema = TABLES[name].schema

        def value(field, row):
            if field.name in row:
                found = row[field.name]
                return Decimal(str(found)) if isinstance(found, (int, float)) and "decimal" in field.dataType.simpleString() else found
            if field.nullable:
                return None
            return DEFAULTS.get(field.dataType.simpleString(), Decimal("1.00"))

        for field in schema.fields:
            field.nullable = field.nullable or any(field.name in r and r[field.name] is None for r in rows)
        return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in rows], schema)

    return build


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (or by all)."""
    found = [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
    return found


def d(text: str) -> Decimal:
    return Decimal(text)
