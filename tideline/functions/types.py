"""Origin types as Spark types, with overrides (section 1.3, DG13, PJ1-PJ6)."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The origin's type names and the destination types they become.
DESTINATION = {
    "integer": "integer",
    "int": "integer",
    "tinyint": "integer",
    "smallint": "integer",
    "mediumint": "bigint",
    "bigint": "bigint",
    "bit": "integer",
    "year": "integer",
    "decimal": "numeric",
    "float": "double precision",
    "double": "double precision",
    "double precision": "double precision",
    "bool": "boolean",
    "boolean": "boolean",
    "char": "character",
    "varchar": "character varying",
    "character varying": "character varying",
    "tinytext": "text",
    "text": "text",
    "mediumtext": "text",
    "longtext": "text",
    "datetime": "timestamp without time zone",
    "timestamp": "timestamp without time zone",
    "date": "date",
    "time": "time without time zone",
    "tinyblob": "bytea",
    "blob": "bytea",
    "mediumblob": "bytea",
    "longblob": "bytea",
    "binary": "bytea",
    "varbinary": "bytea",
    "enum": "enum",
    "set": "text",
    "json": "json",
    "geometry": "bytea",
    "point": "bytea",
    "linestring": "bytea",
    "polygon": "bytea",
    "multipoint": "bytea",
    "multilinestring": "bytea",
    "geometrycollection": "bytea",
}
SPATIAL = {"geometry", "point", "linestring", "polygon", "multipoint", "multilinestring", "geometrycollection"}
BYTES = {"tinyblob", "blob", "mediumblob", "longblob", "binary", "varbinary"}
SPARK = {
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "double precision": T.DoubleType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
    "character": T.StringType(),
    "character varying": T.StringType(),
    "enum": T.StringType(),
    "json": T.StringType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "date": T.DateType(),
    "time without time zone": T.StringType(),
    "bytea": T.BinaryType(),
}


@dataclass(frozen=True)
class Override:
    """A destination type for all columns of one full origin type, in the tables named, or in all with ``*``."""

    to: str
    tables: tuple[str, ...] = ("*",)


def destination_type(data_type: str, column_type: str | None = None, table: str = "", overrides: Mapping[str, Override] | None = None) -> str:
    """DG13: the destination type of a column; an override of the full type comes before the dictionary."""
    full = re.sub(r"\s*,\s*", ",", (column_type or data_type).lower().strip())
    rule = (overrides or {}).get(full)
    if rule and ("*" in rule.tables or table in rule.tables):
        return rule.to.lower()
    try:
        return DESTINATION[data_type.lower()]
    except KeyError:
        raise ValueError(f"no destination type for {data_type!r}") from None


def spark_type(data_type: str, column_type: str | None = None, precision: int | None = None, scale: int | None = None, table: str = "", overrides: Mapping[str, Override] | None = None) -> T.DataType:
    """The Spark type of a column. Unsigned integers are widened, so their upper half fits."""
    to = destination_type(data_type, column_type, table, overrides)
    if to == "numeric":
        return T.DecimalType(min(precision or 38, 38), min(scale or 0, min(precision or 38, 38)))
    if "unsigned" in (column_type or "").lower() and to in ("integer", "bigint"):
        return T.LongType() if to == "integer" else T.DecimalType(20, 0)
    try:
        return SPARK[to]
    except KeyError:
        raise ValueError(f"no Spark type for {to!r}") from None


def hex_text(value: Column) -> Column:
    """PJ3: bytes as lower-case hex; empty bytes give an empty text."""
    return F.lower(F.hex(value))


def spatial_text(value: Column) -> Column:
    """PJ4: hex of a spatial value without its four-byte reference system."""
    return F.substring(hex_text(value), 9, 1 << 30)


def no_zero_date(value: Column, kind: str = "timestamp_ntz") -> Column:
    """PJ1: a date or time text; the zero date and what can't be read become null."""
    text = F.when(~value.startswith("0000-00-00"), value)
    return text.try_cast(kind)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without time zone, whatever the session's zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def no_nul(value: Column) -> Column:
    """SK5: a text without NUL characters."""
    return F.replace(value, F.lit("\0"), F.lit(""))


def typed(value: Column, data_type: str, kind: T.DataType) -> Column:
    """PJ1, SK3: an origin's text as the Spark type; null where it can't be read, never an error."""
    name = data_type.lower()
    if name in ("datetime", "timestamp", "date"):
        return no_zero_date(value, kind.simpleString())
    if name in SPATIAL:
        return F.try_to_binary(spatial_text(F.try_to_binary(value, F.lit("hex"))), F.lit("hex"))
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(value, F.lit("hex"))
    return value.try_cast(kind)


def csv_field(value: Column) -> Column:
    """PJ2: a text as a quoted field; null as the bare sentinel, which a text ``NULL`` is kept apart from by its quotes."""
    return F.coalesce(F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("NULL"))


def quoted_literal(value: Column) -> Column:
    """PJ10: a text as an SQL literal, NULL for null."""
    return F.coalesce(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


def quoted_name(name: Column) -> Column:
    """PJ10: a name as a quoted identifier."""
    return F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))


def memory_bytes(text: str) -> int:
    """SC2: ``300M`` and the like, with k, M or G, as bytes."""
    found = re.fullmatch(r"\s*(\d+)\s*([kKmMgG]?)[bB]?\s*", str(text))
    if not found:
        raise ValueError(f"not an amount of memory: {text!r}")
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[found[2].lower()]


def slice_rows(memory: str, average_row: int | None, default: int = 1_000_000) -> int:
    """SC2: rows a slice may have for its memory; the default where no row size is known."""
    return max(1, round(memory_bytes(memory) / average_row)) if average_row else default
