"""Shipped orders of a day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shipped_orders(orders: DataFrame, first: date, last: date | None = None) -> DataFrame:
    """Orders with a transaction time on ``first`` (or first..last), shipped, neither
    cancelled nor refunded. The time bounds are constants on the bare column, so they reach
    the scan."""
    end = F.date_add(F.lit(last or first), 1)
    time = F.col("trans_dtm")
    return orders.where(
        (time >= F.lit(first)) & (time < end)
        & (F.col("is_ship") == 1) & (F.col("is_cancel") == 0) & (F.col("is_refund") == 0)
    )
