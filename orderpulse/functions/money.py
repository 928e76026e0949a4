"""Money arithmetic on exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderpulse.schemas import MONEY


def order_revenue(price: Column, quantity: Column) -> Column:
    """Streaming revenue of one order: unit price times quantity."""
    return price * quantity


def money_round(amount: Column) -> Column:
    """Two decimals, half away from zero."""
    return F.round(amount, 2).cast(MONEY)


def safe_average(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` to two decimals, 0 when nothing was counted.

    ``total`` has ``scale`` decimals. The division runs on whole units, because
    a decimal quotient is cut to six digits first and would be rounded twice.
    """
    units = (F.abs(total) * F.lit(10 ** scale)).cast("decimal(38,0)")
    step = count.cast("decimal(20,0)") * F.lit(10 ** (scale - 2))
    # Taking the remainder off first leaves a quotient without decimals, at any size.
    doubled, whole = units * 2 + step, step * 2
    cents = ((doubled - doubled % whole) / whole).cast("decimal(34,0)")
    signed = F.when(total < 0, -cents).otherwise(cents)
    return (F.when(count > 0, (signed / 100).cast(MONEY))
            .otherwise(F.lit(0).cast(MONEY)))


def money_to_double(amount: Column) -> Column:
    """Decimal to double at the output edge; null stays null."""
    return amount.cast("double")


def price_or_total_price(price: Column, total_price: Column) -> Column:
    """The posted price, else the posted total, else 0."""
    return F.coalesce(price, total_price, F.lit(0))
