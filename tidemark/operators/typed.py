"""JSON topics as typed tables: rows that parse, and records that do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

from tidemark.operators.records import LONGS, as_long, read_json
from tidemark.schemas import QUARANTINE_TOPIC


def typed(records: DataFrame, schema: str) -> DataFrame:
    """Records ``(id, value)`` with the members of ``schema`` in ``row`` and the names of bad ones in ``bad``.

    A member is bad when it is there and cannot be read as its type; numbers and truth values may be quoted, and
    an integer's fraction is cut off. A missing or null member is null and not bad. A text that is not one JSON
    object and nothing more has no ``row``. The text is parsed once, members that are objects or arrays again on
    their own; those are bad only as a whole, what is in them becomes null where it does not fit.
    """
    fields = StructType.fromDDL(schema).fields
    parsed = read_json(records.select("id", "value"), ", ".join(f"{_quoted(f.name)} string" for f in fields))
    values = [_value(f).alias(f.name) for f in fields]
    bad = [F.when(_text(f).isNotNull() & _value(f).isNull(), F.lit(f.name)) for f in fields]
    whole = F.col("read").isNotNull()
    return parsed.select("id", "value", F.when(whole, F.struct(*values)).alias("row"), F.array_compact(F.array(*bad)).alias("bad"))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _text(field: StructField) -> Column:
    return F.col("read")[field.name]


def _value(field: StructField) -> Column:
    kind = field.dataType.simpleString()
    if kind in LONGS:
        return as_long(_text(field)).try_cast(kind)
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        # an array would be taken for an object that lacks all members
        begins = _text(field).startswith("[" if isinstance(field.dataType, ArrayType) else "{")
        return F.when(begins, F.from_json(_text(field), field.dataType))
    return _text(field).try_cast(kind)


def _is_good() -> Column:
    return F.col("row").isNotNull() & (F.size("bad") == 0)


def rows(parsed: DataFrame) -> DataFrame:
    """The typed rows of :func:`typed`: one for each record that is an object without a bad member."""
    return parsed.filter(_is_good()).select("row.*")


def unreadable(parsed: DataFrame) -> DataFrame:
    """All other records, as quarantine records ``(topic, id, value)``."""
    return parsed.filter(~_is_good()).select(F.lit(QUARANTINE_TOPIC).alias("topic"), "id", "value")
