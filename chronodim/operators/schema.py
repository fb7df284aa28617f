"""Schema-change policies of an incremental table.

* ``sync_all_columns`` -- the new select defines the table: columns it adds
  appear (NULL in untouched rows), columns it drops disappear.
* ``ignore`` -- the table keeps its columns: new source columns are ignored,
  missing ones are NULL in new rows.

Under both a column whose type changes takes the least common type of old and
new (:func:`common_type`), so no value is lost and no run stops.  All are plain
projections, so they cost nothing beyond the scan and keep the plan inside
codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POLICIES = ("sync_all_columns", "ignore")

# Whole numbers by width, with the decimal digits that hold all their values.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
DIGITS = 38  # of the widest decimal


def _decimal(t: T.DataType) -> T.DecimalType | None:
    """The decimal that holds every value of a whole-number or decimal type."""
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(WHOLE[type(t)], 0) if type(t) in WHOLE else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both.

    Whole numbers widen; with decimals they give a decimal of all whole and all
    fraction digits; float and double give double, also with whole numbers
    (as Spark does: beyond 2**53 rounded) and decimals.  Dates become
    timestamps, zone-free ones become zoned.  Arrays, maps and structs widen
    member by member.  Anything meets text as text.  Other pairs, and
    decimals beyond 38 digits, are an error.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in WHOLE and type(b) in WHOLE:
        return max(a, b, key=lambda t: WHOLE[type(t)])
    x, y = _decimal(a), _decimal(b)
    if x and y:
        scale = max(x.scale, y.scale)
        precision = max(x.precision - x.scale, y.precision - y.scale) + scale
        if precision > DIGITS:
            raise ValueError(f"no decimal holds both {a.simpleString()} and {b.simpleString()}")
        return T.DecimalType(precision, scale)
    real = (T.FloatType, T.DoubleType)
    if (isinstance(a, real) or x) and (isinstance(b, real) or y):
        return T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return max(a, b, key=lambda t: times.index(type(t)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType) and a.names == b.names:
        return T.StructType([T.StructField(n, common_type(a[n].dataType, b[n].dataType)) for n in a.names])
    if isinstance(a, T.StringType) and isinstance(b, T.AtomicType) or isinstance(b, T.StringType) and isinstance(a, T.AtomicType):
        return T.StringType()
    raise ValueError(f"no common type of {a.simpleString()} and {b.simpleString()}")


def widened(old: T.StructType, new: T.StructType, keep: bool = True) -> T.StructType:
    """Columns of ``new`` with common types, then (``keep``) those only ``old`` has."""
    fields = [T.StructField(f.name, common_type(old[f.name].dataType, f.dataType) if f.name in old.names else f.dataType) for f in new.fields]
    return T.StructType(fields + [f for f in old.fields if keep and f.name not in new.names])


def type_changes(old: T.StructType, new: T.StructType) -> list[str]:
    """Columns of both whose types differ."""
    return [f.name for f in new.fields if f.name in old.names and old[f.name].dataType != f.dataType]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` projected onto ``schema``: same column order and types, NULL for
    columns ``df`` lacks, extra columns dropped."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def align_types(state: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with common types in the columns they share."""
    if not type_changes(state.schema, changes.schema):
        return state, changes
    both = widened(state.schema, changes.schema)
    return tuple(conform(df, T.StructType([both[c] for c in df.columns])) for df in (state, changes))


def evolve(state: DataFrame, changes: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Align table state and incoming rows under ``policy``; returns both with
    one common schema, ready for ``upsert``."""
    if policy not in POLICIES:
        raise ValueError(f"unknown schema policy {policy!r}; expected one of {POLICIES}")
    state, changes = align_types(state, changes)
    like = state.schema if policy == "ignore" else changes.schema
    return conform(state, like), conform(changes, like)
