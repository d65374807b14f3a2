"""Null-aware join keys.

dplyr joins match NULL to NULL; SQL joins do not. Both are expressed with
one non-null key pair ``(_k_null, _k_val)``: a plain equi-join on the pair
is a null-safe join on the original column, and dropping NULL keys from the
lookup side turns it back into SQL semantics. The pair is projected once,
so grouping, window checks and joins on it share one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

KEY_NULL = "_k_null"
KEY_VAL = "_k_val"
KEY_COLS = [KEY_NULL, KEY_VAL]


def quoted(col: str) -> str:
    """A column name as the column parser reads it, dots and back quotes included."""
    return "`" + col.replace("`", "``") + "`"


def key_exprs(col: Column | str, dtype: T.DataType | None = None) -> dict[str, Column]:
    """The key pair for ``col``. The value keeps the column's type (a long
    key stays a long), the filler for NULL is never compared on its own."""
    c = F.col(col) if isinstance(col, str) else col
    if dtype is None or isinstance(dtype, T.StringType):
        filler = F.lit("")
        c = c.cast("string")
    elif isinstance(dtype, T.NumericType):
        filler = F.lit(0).cast(dtype)
    else:
        filler = F.lit("")
        c = c.cast("string")
    return {KEY_NULL: c.isNull(), KEY_VAL: F.coalesce(c, filler)}


def add_key(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns(key_exprs(col, df.schema[col].dataType))
