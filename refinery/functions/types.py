"""Column types: which hold all values of another, and how two grow into one."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, MapType, StructField, StructType

from refinery.functions.columns import quoted

_WHOLE = ("tinyint", "smallint", "int", "bigint")
# Decimal digits that hold every value of a whole type; whole types that a double holds.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_IN_DOUBLE = ("tinyint", "smallint", "int", "float")


def fits_losslessly(given: DataType, wanted: DataType) -> bool:
    """Whether every value of one type is one of the other; nullability does not count."""
    a, b = given.simpleString(), wanted.simpleString()
    if a == b or a == "void":
        return True
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE.index(a) <= _WHOLE.index(b)
    if b == "double":
        return a in _IN_DOUBLE
    if b == "float":
        return a in _IN_DOUBLE[:2]
    if isinstance(wanted, DecimalType):
        room = wanted.precision - wanted.scale
        if isinstance(given, DecimalType):
            return given.scale <= wanted.scale and given.precision - given.scale <= room
        return _DIGITS.get(a, 99) <= room
    return False


def type_ddl(kind: DataType) -> str:
    """The type as DDL, with the names of nested fields quoted."""
    if isinstance(kind, StructType):
        return f"struct<{', '.join(f'{quoted(f.name)}: {type_ddl(f.dataType)}' for f in kind)}>"
    if isinstance(kind, ArrayType):
        return f"array<{type_ddl(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{type_ddl(kind.keyType)}, {type_ddl(kind.valueType)}>"
    return kind.simpleString()


def _partner(kind: StructType, name: str) -> StructField | None:
    return next((f for f in kind if f.name.lower() == name.lower()), None)


def merged_type(held: DataType, given: DataType) -> DataType:
    """``held`` grown by the fields that only ``given`` has, at any depth; no type in it changes."""
    if isinstance(held, StructType) and isinstance(given, StructType):
        fields = []
        for f in held:
            other = _partner(given, f.name)
            fields.append(StructField(f.name, merged_type(f.dataType, other.dataType) if other else f.dataType))
        return StructType(fields + [StructField(f.name, f.dataType) for f in given if not _partner(held, f.name)])
    if isinstance(held, ArrayType) and isinstance(given, ArrayType):
        return ArrayType(merged_type(held.elementType, given.elementType))
    if isinstance(held, MapType) and isinstance(given, MapType):
        return MapType(held.keyType, merged_type(held.valueType, given.valueType))
    return held


def _same_shape(given: DataType, wanted: DataType) -> bool:
    if isinstance(given, MapType) and isinstance(wanted, MapType):
        return fits_losslessly(given.keyType, wanted.keyType)
    return any(isinstance(given, k) and isinstance(wanted, k) for k in (StructType, ArrayType))


def as_type(value: Column, given: DataType, wanted: DataType) -> Column:
    """``value`` rebuilt in the wanted type: missing fields and what does not fit are null."""
    if given.simpleString() == wanted.simpleString():
        return value
    if not _same_shape(given, wanted):
        return (value if fits_losslessly(given, wanted) else F.lit(None)).cast(wanted)
    if isinstance(given, ArrayType):
        return F.transform(value, lambda x: as_type(x, given.elementType, wanted.elementType))
    if isinstance(given, MapType):
        keyed = value if given.keyType == wanted.keyType else F.transform_keys(value, lambda k, _: k.cast(wanted.keyType))
        return F.transform_values(keyed, lambda _, v: as_type(v, given.valueType, wanted.valueType))
    fields = []
    for f in wanted:
        own = _partner(given, f.name)
        field = as_type(value.getField(own.name), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
        fields.append(field.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*fields))


def misfits(value: Column, given: DataType, wanted: DataType) -> Column | None:
    """The parts of ``value`` that ``as_type`` leaves out, in their places; null where there are
    none, and no column where there cannot be any."""
    if not _same_shape(given, wanted):
        return None if fits_losslessly(given, wanted) else value
    if isinstance(given, ArrayType):
        part = lambda x: misfits(x, given.elementType, wanted.elementType)
        if part(F.lit(None)) is None:
            return None
        return F.when(F.exists(value, lambda x: part(x).isNotNull()), F.transform(value, part))
    if isinstance(given, MapType):
        part = lambda x: misfits(x, given.valueType, wanted.valueType)
        if part(F.lit(None)) is None:
            return None
        left = F.map_filter(value, lambda _, v: part(v).isNotNull())
        return F.when(F.size(left) > 0, F.transform_values(left, lambda _, v: part(v)))
    parts = []
    for f in wanted:
        own = _partner(given, f.name)
        left = misfits(value.getField(own.name), own.dataType, f.dataType) if own else None
        if left is not None:
            parts.append((own.name, left))
    if not parts:
        return None
    some = reduce(or_, [left.isNotNull() for _, left in parts])
    return F.when(some, F.struct(*[left.alias(name) for name, left in parts]))
