"""Exact money: decimals in, decimals out; doubles only at the outer edge."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

MONEY = "decimal(15,2)"
ZERO = Decimal("0.00")


def money(col: Column) -> Column:
    return col.cast(MONEY)


def line_total(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    """quantity x unit price less the percentage discount, to the cent."""
    # Hundredths by multiplication: exact like the division, and much cheaper.
    kept = (100 - F.coalesce(discount_percent, F.lit(ZERO))) * Decimal("0.01")
    return F.round(quantity * unit_price * kept, 2).cast(MONEY)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as an unrounded double; NULL where whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def published(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for consumers without a decimal type."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        )
    )
