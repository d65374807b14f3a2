"""Logical schemas of the reconciled tables.

The source systems publish no DDL; these are the types the jobs need. A
reader checks them once, at read time, so a drifted source fails before any
join runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, L, I = T.StringType(), T.LongType(), T.IntegerType()
TS, TS_NTZ = T.TimestampType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "members": _struct(("id", S), ("email", S)),
    "users": _struct(("id", L), ("email", S), ("fname", S), ("lname", S),
                     ("created_at", TS_NTZ), ("hn_member_id", S)),
    "transactions": _struct(("id", L), ("customer_email", S), ("member_id", S), ("date", TS_NTZ)),
    "reservations": _struct(("id", L), ("customer_email", S), ("member_id", S)),
    "invoices": _struct(("id", L), ("reservation_id", L), ("customer_id", S)),
    "tickets": _struct(("id", L), ("user_id", L), ("boe_event_id", L), ("boe_ticket_id", L)),
}

# Columns of the member table an insert writes, in statement order.
MEMBER_INSERT = _struct(
    ("id", S), ("email", S), ("name", S), ("phone_number", S), ("address", S),
    ("email_verified", I), ("phone_verified", I), ("created_at", TS),
    ("external_id", L), ("updated_at", TS), ("member_since", TS_NTZ),
)


def check_target(df: DataFrame, name: str, needed: list[str]) -> DataFrame:
    """``df`` as stored, with all its columns and types, for a table that is
    written back whole; only checks that ``needed`` exist and can be cast to
    their logical types."""
    schema, have = SCHEMAS[name], set(df.columns)
    missing = [c for c in needed if c not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}; found {sorted(have)}")
    df.select(*[df[c].cast(schema[c].dataType) for c in needed])  # analysed at once: a type that cannot be cast raises
    return df


def check_schema(df: DataFrame, name: str, columns: list[str] | None = None,
                 *, strict_types: bool = False) -> DataFrame:
    """Select ``columns`` (default: all logical columns) and verify them.

    Missing columns raise. Types must be compatible; with ``strict_types``
    they must match exactly, otherwise they are cast to the logical type.
    """
    schema = SCHEMAS[name]
    wanted = columns or schema.fieldNames()
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in wanted if c not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}; found {sorted(have)}")
    out = []
    for c in wanted:
        target = schema[c].dataType
        if have[c] == target:
            out.append(df[c])
        elif strict_types:
            raise TypeError(f"{name}.{c}: expected {target.simpleString()}, got {have[c].simpleString()}")
        else:
            out.append(df[c].cast(target).alias(c))
    return df.select(*out)
