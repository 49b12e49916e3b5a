"""JSON records: text in, typed columns out, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LONGS = ("bigint", "int")

# A member no record has; it marks the end of a text.
_END = "_tidemark_end"


def parse_json(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Replace nothing, add the members named by ``schema`` of the JSON object ``value``.

    Text that is not one JSON object and nothing more gives nulls. The parser itself stops at the
    end of the object, so the text is read as an array with a mark behind it. The members go
    through a one-row generator: without it the optimizer copies the parse into every filter
    it pushes down, and each text is parsed twice or more.
    """
    alone = F.transform(F.array(_marked(schema, value)), lambda r: F.when(_is_alone(r), F.get(r, F.lit(0))))
    return df.select("*", F.inline(alone)).drop(_END)


def read_json(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """As :func:`parse_json`, with the members in the struct ``read``: null unless the text is one object, which may be empty."""
    alone = F.transform(
        F.array(_marked(schema, value)), lambda r: F.struct(F.when(_is_alone(r), F.get(r, F.lit(0))).alias("read"))
    )
    return df.select("*", F.inline(alone))


def _marked(schema: str, value: str) -> Column:
    marked = F.concat(F.lit("["), value, F.lit(f',{{"{_END}":1}}]'))
    return F.from_json(marked, f"array<struct<{_members(schema)}, {_END}:int>>")


def _is_alone(read: Column) -> Column:
    return (F.size(read) == 2) & (F.get(read, F.lit(1))[_END] == 1)


def _members(schema: str) -> str:
    """The fields of a schema in the form of a struct type."""
    fields = StructType.fromDDL(schema).fields
    return ",".join(f"`{f.name.replace('`', '``')}`:{f.dataType.simpleString()}" for f in fields)


def as_long(text: Column) -> Column:
    """An integer member read as text, whether it was quoted or not; fractions are cut off."""
    whole = text.try_cast("bigint")
    return F.coalesce(whole, text.try_cast("decimal(38,6)").try_cast("bigint"))


def parse_fields(df: DataFrame, types: dict[str, str], value: str = "value") -> DataFrame:
    """Parse a flat JSON object into the columns of ``types``, keeping the other columns.

    Numbers may be quoted: integers are read as text, and decimals accept both anyway.
    """
    read_as = {name: "string" if kind in LONGS else kind for name, kind in types.items()}
    parsed = parse_json(df, ", ".join(f"{name} {kind}" for name, kind in read_as.items()), value)
    longs = {name: as_long(F.col(name)) for name, kind in types.items() if kind in LONGS}
    return parsed.withColumns(longs)


def is_filled_object(text: Column) -> Column:
    """True when a member read as text is an object with at least one member."""
    return F.coalesce(text.rlike(r'^\s*\{\s*"'), F.lit(False))


def json_null_free(entries: Column) -> Column:
    """Drop null members of a ``map<string,variant>``, which ``to_json`` would print."""
    return F.map_filter(entries, lambda k, v: v.isNotNull() & ~F.is_variant_null(v))


def with_entry(entries: Column, key: str, value: Column) -> Column:
    """Set one member of a ``map<string,variant>``, replacing what was there."""
    others = F.map_filter(entries, lambda k, v: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), value))


def text_variant(text: Column) -> Column:
    """A string column as a JSON string value."""
    return text.cast("variant")
