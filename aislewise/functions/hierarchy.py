"""Item codes and the hierarchy in their prefixes.

An item code such as ``DEBG2H-A70201693`` starts with its store (6 characters);
5 characters name the store family, 4 the region, 3 the region family.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STORE_CHARS = 6
STORE_FAMILY_CHARS = 5
REGION_CHARS = 4
REGION_FAMILY_CHARS = 3


def prefix(code: Column, chars: int) -> Column:
    return F.substring(code, 1, chars)


def item_of_sku(sku: Column) -> Column:
    """SKU without its last ``-`` part; NULL when there is no ``-``."""
    return F.when(sku.contains("-"), F.regexp_replace(sku, "-[^-]*$", ""))


def is_user_code(user: Column) -> Column:
    return user.rlike(r"^\w{40}$")


def is_item_code(item: Column) -> Column:
    return item.rlike(r"^\w{6}-\w{9}$")


def is_group_code(group: Column, chars: int) -> Column:
    return group.rlike(r"^\w{%d}$" % chars)
