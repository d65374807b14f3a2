"""Date predicates written so they reach the scan.

``YEAR(date) >= y`` wraps the column, and Spark pushes only ``IsNotNull`` for
it. The equivalent range ``date >= y-01-01`` is pushed as a comparison, so
parquet row groups (and JDBC ``WHERE``) skip older data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def at_least_year(df: DataFrame, col: str, year: int) -> Column:
    """``year(col) >= year`` as a range on the raw column (same rows, NULL excluded)."""
    dtype = df.schema[col].dataType
    bound = F.lit(f"{int(year):04d}-01-01 00:00:00").cast(dtype)
    return F.col(col) >= bound
