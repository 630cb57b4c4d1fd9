"""The JSON forms of a feed message.

Feeds write codes as numbers or by name, whole numbers as numbers or as text, and members as
``trip_update`` or ``tripUpdate``. Lines are read with a type that takes all of these and are then
settled to the type of ``schemas.FEED_MESSAGE``. Everything is column functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from headway.functions.codes import code_label, code_number

# Members that hold a code, by the member around them, and the list of its names.
CODE_MEMBERS = {("trip", "schedule_relationship"): "trip_relationship",
                ("stop_time_update", "schedule_relationship"): "stop_relationship",
                ("vehicle", "current_status"): "vehicle_status", ("alert", "cause"): "cause",
                ("alert", "effect"): "effect", ("alert", "severity_level"): "severity"}


def camel(name: str) -> str:
    first, *others = name.split("_")
    return first + "".join(x.title() for x in others)


def _spelt(value: Column, name: str) -> list[Column]:
    """A member in each of its spellings; the first that is there counts."""
    return [value[n] for n in dict.fromkeys((name, camel(name)))]


def accepted(kind: T.DataType) -> T.DataType:
    """The type to read ``kind`` with: both spellings of members, whole numbers as their text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(n, accepted(f.dataType))
                             for f in kind for n in dict.fromkeys((f.name, camel(f.name)))])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(accepted(kind.elementType))
    return T.StringType() if isinstance(kind, T.IntegralType) else kind


def settled(value: Column, kind: T.DataType, name: str = "", around: str = "") -> Column:
    """``value``, read as ``accepted(kind)``, as ``kind``; what names no number is NULL."""
    if isinstance(kind, T.StructType):
        members = [_settled_member(value, f, name).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: settled(e, kind.elementType, name, around))
    if isinstance(kind, T.IntegralType):
        number = value.try_cast(kind)
        codes = CODE_MEMBERS.get((around, name))
        return F.coalesce(number, code_number(codes, value).cast(kind)) if codes else number
    if name == "incrementality":
        return F.coalesce(code_label("incrementality", value.try_cast("int")), value)
    return value


def _settled_member(value: Column, field: T.StructField, around: str) -> Column:
    first, *others = _spelt(value, field.name)
    if isinstance(field.dataType, T.StructType) and others:
        # Each spelling is followed by itself: all that lies below a choice would choose once more.
        either = F.when(first.isNotNull(), settled(first, field.dataType, field.name, around))
        return either.otherwise(settled(others[0], field.dataType, field.name, around))
    return settled(F.coalesce(first, *others), field.dataType, field.name, around)


def misread(value: Column, kind: T.DataType, name: str = "", around: str = "") -> Column:
    """Whether ``value``, read as ``accepted(kind)``, holds text where a number or the name of a
    code should be; never NULL."""
    if isinstance(kind, T.StructType):
        # What is missing is not looked into, so an entity costs only what it holds.
        tests = []
        for f in kind:
            if _holds_numbers(f.dataType):
                first, *others = _spelt(value, f.name)
                tests.append(misread(first, f.dataType, f.name, name))
                tests += [first.isNull() & misread(x, f.dataType, f.name, name) for x in others]
        return value.isNotNull() & reduce(Column.__or__, tests)
    if isinstance(kind, T.ArrayType):
        bad = F.exists(value, lambda e: misread(e, kind.elementType, name, around))
        return F.coalesce(bad, F.lit(False))
    return value.isNotNull() & settled(value, kind, name, around).isNull()


def _holds_numbers(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_numbers(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_numbers(kind.elementType)
    return isinstance(kind, T.IntegralType)
