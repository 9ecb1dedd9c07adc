"""Wire values of source types, as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timeuuid import chronological_order, signed_order

#: Source scalar types and the Spark types of their values on the wire (fixed values).
SCALARS = {
    "ascii": "string", "text": "string", "varchar": "string", "bigint": "long", "counter": "long", "int": "int",
    "smallint": "short", "tinyint": "byte", "float": "float", "double": "double", "boolean": "boolean", "blob": "binary",
    "date": "int", "time": "long", "timestamp": "long", "decimal": "string", "varint": "string", "uuid": "string",
    "timeuuid": "string", "inet": "string", "duration": "string",
}


def scalar(c: Column, source_type: str) -> Column:
    """Dates are days, timestamps milliseconds, times nanoseconds, unbounded numbers text."""
    if source_type not in SCALARS:
        raise ValueError(f"unknown type {source_type!r}")
    if source_type == "date":
        return F.unix_date(c)
    if source_type == "timestamp":
        return F.unix_millis(c)
    return c.cast(SCALARS[source_type])


def entries(c: Column) -> Column:
    """A map as an array of {key, value}: keys need not be text."""
    return F.map_entries(c)


def ordered_values(c: Column, chronological: bool = False) -> Column:
    """A list kept as map<timeuuid, value>: its values in key order."""
    order = chronological_order if chronological else signed_order
    keyed = F.transform(F.map_entries(c), lambda e: F.struct(order(e["key"]).alias("k"), e["value"].alias("v")))
    return F.transform(F.sort_array(keyed), lambda e: e["v"])


def tuple_struct(*values: Column) -> Column:
    """A tuple is a struct field_0, field_1 ...; of nulls it stays a struct."""
    return F.struct(*[v.alias(f"field_{i}") for i, v in enumerate(values)])


def _filled(c: Column, kind: T.DataType) -> Column:
    """Whether a user-type field counts as filled: not null, no empty collection, no user type without filled fields."""
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def collapse_udt(c: Column, kind: T.StructType) -> Column:
    """A user type whose fields are all null or empty is null; inner ones first."""
    parts = [(f.name, collapse_udt(c[f.name], f.dataType) if isinstance(f.dataType, T.StructType) else c[f.name], f.dataType) for f in kind.fields]
    some = F.lit(False)
    for _, v, k in parts:
        some = some | _filled(v, k)
    return F.when(c.isNotNull() & some, F.struct(*[v.alias(n) for n, v, _ in parts]))


@dataclass(frozen=True)
class Kind:
    """A source type: its name, its arguments, and a user type's field names."""

    name: str
    args: tuple[Kind, ...] = ()
    fields: tuple[str, ...] = ()


ARITY = {"list": 1, "set": 1, "map": 2}


def parse_type(text: str, user_types: Mapping[str, Mapping[str, str]] | None = None) -> Kind:
    """A type's text as it stands in a table's definition; `frozen` makes no difference to values.

    user_types: the fields of user types, by type name and field name.
    """
    user_types = user_types or {}
    tokens = re.findall(r"[\w.]+|[<>,]", text)

    def one() -> Kind:
        name = tokens.pop(0)
        args = []
        if tokens and tokens[0] == "<":
            while tokens.pop(0) != ">":
                args.append(one())
        low = name.lower()
        if low == "frozen" and len(args) == 1:
            return args[0]
        if name in user_types and not args:
            return Kind("udt", tuple(parse_type(t, user_types) for t in user_types[name].values()), tuple(user_types[name]))
        if ARITY.get(low, len(args)) != len(args) or (args and low not in ARITY and low != "tuple"):
            raise ValueError(f"{name} with {len(args)} type arguments in {text!r}")
        if not args and low not in SCALARS:
            raise ValueError(f"unknown type {name!r}")
        return Kind(low, tuple(args))

    try:
        found = one()
    except IndexError:
        raise ValueError(f"not a type: {text!r}") from None
    if tokens:
        raise ValueError(f"not a type: {text!r}")
    return found


def value(c: Column, kind: Kind, base: Kind | None = None, chronological: bool = False) -> Column:
    """A column of a source type as its wire value, however nested.

    Tuples come as structs field_0, field_1 ..., user types as structs of their fields. base: the column's type in its table;
    a list there that the log keeps as map<timeuuid, value> gives its values in key order. Nested types have no other form.
    """
    if kind.name in ("list", "set"):
        return F.transform(c, lambda e: value(e, kind.args[0]))
    if kind.name == "map":
        if base is not None and base.name == "list" and kind.args[0].name == "timeuuid":
            return F.transform(ordered_values(c, chronological), lambda e: value(e, kind.args[1]))
        return F.transform(entries(c), lambda e: F.struct(value(e["key"], kind.args[0]).alias("key"), value(e["value"], kind.args[1]).alias("value")))
    if kind.name == "tuple":
        return F.when(c.isNotNull(), tuple_struct(*[value(c[f"field_{i}"], k) for i, k in enumerate(kind.args)]))
    if kind.name == "udt":
        if kind.fields == ("elements",) and kind.args[0].name == "udt":
            return value(c["elements"], kind.args[0])
        made = [(n, k, value(c[n], k)) for n, k in zip(kind.fields, kind.args)]
        some = F.lit(False)
        for _, k, v in made:
            some = some | (v.isNotNull() & (F.size(v) > 0) if k.name in ARITY else v.isNotNull())
        return F.when(c.isNotNull() & some, F.struct(*[v.alias(n) for n, _, v in made]))
    return scalar(c, kind.name)


def as_text(c: Column, kind: T.DataType) -> Column:
    """A header's text of a key value."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    return c.cast("string")


def schema_name(kind: T.DataType) -> str:
    """Name of a nested type in a schema registry."""
    if isinstance(kind, T.MapType):
        return f"Map_{schema_name(kind.keyType)}_{schema_name(kind.valueType)}"
    if isinstance(kind, T.ArrayType):
        return f"List_{schema_name(kind.elementType)}"
    if isinstance(kind, T.StructType):
        label = "Tuple" if all(re.fullmatch(r"field_\d+", f.name) for f in kind.fields) else "UDT"
        return "_".join([label, *(schema_name(f.dataType) for f in kind.fields)])
    return re.sub(r"[.\-(),]", "_", kind.simpleString())
