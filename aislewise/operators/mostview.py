"""Most-viewed items per listed store or region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.functions import hierarchy as H
from aislewise.operators.ranking import top_k_per_group
from aislewise.sources.readers import select_group

TOP = 10


def most_view(interactions: DataFrame, level: str, top: int = TOP) -> DataFrame:
    """(grp, rank, item, cnt): history rows are counted, whatever their own count column."""
    rows = select_group(interactions, level).where(H.is_item_code(F.col("item")) & F.col("grp").isNotNull())
    counts = rows.groupBy("grp", "item").agg(F.count(F.lit(1)).alias("cnt"))
    return top_k_per_group(counts, ["grp"], [F.desc("cnt"), F.asc("item")], top)
