"""Widening of column types: the least type that two types fit in, and casts to it.

The rules, for the types a column has in two batches:

- an untyped null fits in anything,
- integers widen among themselves (byte, short, int, long), a float to a double; an integer and a float or double give a
  double. A long beyond 2^53 is rounded there,
- decimals keep all digits of both sides, an integer counts as a decimal of its digits; beyond 38 digits the type is a string.
  A decimal and a float or double give a double,
- dates widen to timestamps, timestamps without a zone to those with one (read in the session's zone),
- structs widen field by field, arrays and maps by their elements,
- binary meets nothing but binary: bytes need not be text, so anything else raises ``TypeError``,
- all other pairs meet in a string; structs, arrays and maps become JSON text.

The operation is commutative and idempotent. It is associative wherever no string is involved, and a string stays one.
Names are compared without regard to case, as Spark resolves them; the spelling that came first stays.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = (3, 5, 10, 19)
_TIMES = (T.DateType(), T.TimestampNTZType(), T.TimestampType())
_NESTED = (T.StructType, T.ArrayType, T.MapType)
MAX_DIGITS = 38


def _decimal(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _DIGITS[_INTEGERS.index(kind)], 0


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that values of both types fit in."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widest(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType):
        raise TypeError(f"binary and {(b if isinstance(a, T.BinaryType) else a).simpleString()} have no common type")
    for ladder in (_INTEGERS, _TIMES):
        if a in ladder and b in ladder:
            return ladder[max(ladder.index(a), ladder.index(b))]
    fractions = (T.FloatType, T.DoubleType)
    exact = lambda t: t in _INTEGERS or isinstance(t, T.DecimalType)
    if (isinstance(a, fractions) or exact(a)) and (isinstance(b, fractions) or exact(b)):
        if isinstance(a, fractions) or isinstance(b, fractions):
            return T.DoubleType()
        (i, s), (j, t) = _decimal(a), _decimal(b)
        whole, scale = max(i, j), max(s, t)
        return T.DecimalType(whole + scale, scale) if whole + scale <= MAX_DIGITS else T.StringType()
    return T.StringType()


def merge(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, in order of appearance, each of the widest type; columns missing on one side are nullable."""
    for side in (a, b):
        folded = [n.lower() for n in side.names]
        if len(set(folded)) < len(folded):
            raise ValueError(f"column names collide: {sorted(n for n in side.names if folded.count(n.lower()) > 1)}")
    other = {f.name.lower(): f for f in b.fields}
    out = []
    for f in a.fields:
        twin = other.pop(f.name.lower(), None)
        try:
            kind = widest(f.dataType, twin.dataType) if twin else f.dataType
        except TypeError as clash:
            raise TypeError(f"column {f.name}: {clash}") from None
        out.append(T.StructField(f.name, kind, True if twin is None else f.nullable or twin.nullable))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() in other])


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    return reduce(merge, schemas)


def _bare(kind: T.DataType) -> T.DataType:
    """The type with all parts nullable, for comparing and casting."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _bare(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_bare(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_bare(kind.keyType), _bare(kind.valueType), True)
    return kind


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` of type ``have`` as ``want``, which is ``have`` or wider."""
    if _bare(have) == _bare(want):
        return value
    if isinstance(want, T.StringType) and isinstance(have, _NESTED):
        return F.to_json(value)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [
            widened(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*(p.alias(f.name) for p, f in zip(parts, want.fields))))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        pair = lambda e: F.struct(widened(e["key"], have.keyType, want.keyType), widened(e["value"], have.valueType, want.valueType))
        return F.map_from_entries(F.transform(F.map_entries(value), pair))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order: widened where their type differs, null where ``df`` has none."""
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        have = own.get(f.name.lower())
        if have is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            columns.append(widened(df[f"`{have.name}`"], have.dataType, f.dataType).alias(f.name))
    return df.select(*columns)
