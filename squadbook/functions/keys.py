from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite_id(group: Column, year: Column, key: Column) -> Column:
    """``(male, 2020, 158023)`` -> ``M_2020_158023``; NULL when any part is NULL."""
    initial = F.upper(F.substring(group, 1, 1))
    return F.concat(initial, F.lit("_"), year.cast("string"), F.lit("_"), key.cast("string"))
