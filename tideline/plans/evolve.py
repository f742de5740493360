"""DDL on stored tables: schema changes as rewrites of DataFrames (DG1-DG13, A11)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tideline.functions.types import Override, spark_type
from tideline.plans.store import Store
from tideline.sources import ddl


def column_type(column: ddl.Column, table: str = "", overrides: Mapping[str, Override] | None = None):  # noqa: ANN201
    numbers = [int(d) for d in column.dimensions if d.isdigit()]
    return spark_type(column.data_type, column.column_type, numbers[0] if numbers else None, numbers[1] if len(numbers) > 1 else None, table, overrides)


def table_schema(statement: ddl.CreateTable, overrides: Mapping[str, Override] | None = None) -> StructType:
    """DG2: an empty table's schema; allowed values of an enum are kept as metadata."""
    fields = []
    for c in statement.columns:
        fields.append(StructField(c.name, column_type(c, statement.name, overrides), c.nullable, _allowed(c)))
    return StructType(fields)


def _allowed(column: ddl.Column) -> dict[str, list[str]]:
    """DG9: the values of an enum; a statement that lists others replaces them."""
    return {"allowed": list(column.enum_list)} if column.enum_list and column.data_type == "enum" else {}


# PostgreSQL's names of types that have another name here; all others are kept as text.
PG_TYPES = {
    "bigint": "bigint", "boolean": "boolean", "bytea": "binary", "date": "date", "double precision": "double", "integer": "int",
    "real": "float", "smallint": "smallint", "timestamp with time zone": "timestamp", "timestamp without time zone": "timestamp_ntz",
}


def described(columns: Iterable[Mapping[str, Any]]) -> StructType:
    """DG3: the schema that rows of information_schema.columns tell, in the order of their positions.

    A numeric without a precision is a double, as a decimal here needs one.
    """
    fields = []
    for c in sorted(columns, key=lambda c: c["ordinal_position"]):
        kind = PG_TYPES.get(c["data_type"], "string")
        if c["data_type"] == "numeric":
            kind = f"decimal({min(c['numeric_precision'], 38)},{c['numeric_scale'] or 0})" if c["numeric_precision"] else "double"
        fields.append(StructField(c["column_name"], DataType.fromDDL(kind), c["is_nullable"] != "NO"))
    return StructType(fields)


def _literal(text: str | None):  # noqa: ANN202
    if text is None or text.upper().split("(")[0] in ("NULL", "CURRENT_TIMESTAMP", "NOW"):
        return F.lit(None)
    quoted = text[:1] in "'\""
    return F.lit(text[1:-1].replace(text[0] * 2, text[0]) if quoted else text)


def altered(rows: DataFrame, statement: ddl.AlterTable, overrides: Mapping[str, Override] | None = None) -> DataFrame:
    """DG5-DG9: all clauses in order (D: none is lost). A value that the new type can't hold becomes null.

    An added column has its default in old rows. Index clauses do nothing; columns that a clause names but the table
    lacks are left alone, one that it would add again stays.
    """
    for change in statement.changes:
        name = next((c for c in rows.columns if c.lower() == change.name.lower()), None)
        if change.action == "add" and name is None:
            kind = column_type(change.column, statement.name, overrides)
            rows = rows.select("*", _literal(change.column.default).try_cast(kind).alias(change.name, metadata=_allowed(change.column)))
        elif change.action == "drop" and name:
            rows = rows.drop(name)
        elif change.action == "rename" and name:
            rows = rows.withColumnRenamed(name, change.to)
        elif change.action in ("change", "modify") and name:
            kind = column_type(change.column, statement.name, overrides)
            new = change.to or change.name
            rows = rows.select(*((F.col(f"`{c}`").try_cast(kind).alias(new, metadata=_allowed(change.column)) if c == name else F.col(f"`{c}`")) for c in rows.columns))
    return rows


def apply_statement(store: Store, schema: str, statement: ddl.Statement, overrides: Mapping[str, Override] | None = None) -> str:
    """DG1: a statement carried out in the store; returns created, altered, renamed, dropped, truncated, disabled or ignored.

    Statements other than CREATE on tables that aren't stored are ignored (K), as are those without a key (K) and
    unknown ones (D).
    """
    if isinstance(statement, ddl.Unknown):
        return "ignored"
    table = f"{schema}.{statement.name}"
    if isinstance(statement, ddl.CreateTable):
        if not statement.primary_key or store.exists(table):
            return "ignored"
        kind = table_schema(statement, overrides)
        store.write(table, store.spark.createDataFrame([], StructType([StructField(f.name, f.dataType, True, f.metadata) for f in kind.fields])), {"pkey": list(statement.primary_key), "enabled": True, "indices": [[n, list(k.columns)] for n, k in statement.named_keys()]})
        return "created"
    if not store.exists(table):
        return "ignored"
    info = store.info(table)
    if isinstance(statement, ddl.DropTable):
        store.drop(table)
        return "dropped"
    if isinstance(statement, ddl.Truncate):
        store.write(table, store.read(table).limit(0))
        return "truncated"
    if isinstance(statement, ddl.RenameTable):
        store.rename(table, f"{schema}.{statement.to}")
        return "renamed"
    if isinstance(statement, ddl.DropPrimaryKey):
        store.publish({"table": table} | store._pointer(table) | {"info": info | {"enabled": False, "pkey": []}})
        return "disabled"
    before = store.read(table)
    after = altered(before, statement, overrides)
    if after.schema == before.schema:
        return "ignored"
    renamed = {c.name: c.to for c in statement.changes if c.action in ("change", "rename") and c.to}
    store.write(table, after, info | {"pkey": [renamed.get(k, k) for k in info.get("pkey", [])]})
    return "altered"
