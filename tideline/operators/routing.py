"""Which events are kept and where they go (FL1-FL7, FL14, PJ7, JN1, JN6, ST7).

Rules are small tables of configuration. They are turned into expressions
where they are few, else joined; Spark broadcasts them by their measured size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.coordinates import at_or_after
from tideline.sources.config import TableRules

#: Rules of up to this many entries become an expression.
FEW = 200


def table_filter(rules: TableRules, schema: str = "schema_name", table: str = "table_name") -> Column:
    """FL1: skip lists first, then limit lists; schemas without a limit keep all."""
    pair = F.concat_ws(".", schema, table)
    keep = F.lit(True)
    skipped = [f"{s}.{t}" for s, ts in sorted(rules.skip.items()) for t in sorted(ts)]
    if skipped:
        keep = keep & ~pair.isin(skipped)
    limited = sorted(s for s, ts in rules.limit.items() if ts is not None)
    if limited:
        allowed = [f"{s}.{t}" for s in limited for t in sorted(rules.limit[s] or ())]
        keep = keep & (~F.col(schema).isin(limited) | (pair.isin(allowed) if allowed else F.lit(False)))
    return keep


def limit_skip(rows: DataFrame, limit: DataFrame | None, skip: DataFrame | None, keys: list[str]) -> DataFrame:
    """FL1, FL14, JN13: the same with lists of any size: rows in ``limit`` and not in ``skip``."""
    if limit is not None:
        rows = rows.join(limit.select(*keys).distinct(), keys, "left_semi")
    return rows if skip is None else rows.join(skip.select(*keys).distinct(), keys, "left_anti")


def skip_events(rules: Mapping[str, tuple[str, ...]], op: str = "op", schema: str = "schema_name", table: str = "table_name") -> Column:
    """FL2: false for an op on a schema, or a ``schema.table``, that the rules name for it."""
    skipped = F.lit(False)
    for name, entries in sorted(rules.items()):
        if entries:
            skipped = skipped | ((F.col(op) == name) & (F.col(schema).isin(list(entries)) | F.concat_ws(".", schema, table).isin(list(entries))))
    return ~skipped


def statements_kept(query: Column) -> Column:
    """FL5: false for the statements that only bracket a transaction."""
    return ~F.upper(F.trim(query)).isin("BEGIN", "COMMIT")


def mapped(log: DataFrame, mappings: Mapping[str, str], schema: str = "schema_name") -> DataFrame:
    """FL6, PJ7: events of mapped schemas, with ``destination``. A large mapping is joined rather than spelt out."""
    if not mappings:
        return log.withColumn("destination", F.lit(None).cast("string")).where("false")
    if len(mappings) > FEW:
        table = log.sparkSession.createDataFrame(sorted(mappings.items()), f"{schema} string, destination string")
        return log.join(table, schema)
    lookup = F.create_map(*(F.lit(x) for pair in sorted(mappings.items()) for x in pair))
    return log.where(F.col(schema).isin(sorted(mappings))).withColumn("destination", F.element_at(lookup, F.col(schema)))


def registered(log: DataFrame, tables: DataFrame) -> DataFrame:
    """JN1, FL7: events of enabled, registered tables of the same source, with the table's key and watermark (D: source is in the key)."""
    known = tables.where("enabled").select("source", "schema_name", "table_name", "pkey", F.col("binlog_seq").alias("mark_seq"), F.col("binlog_pos").alias("mark_pos"))
    return log.join(known, ["source", "schema_name", "table_name"])


def past_watermark(log: DataFrame) -> DataFrame:
    """FL4, ST7: events at or behind their table's watermark; tables without one keep all. Needs mark_seq and mark_pos."""
    return log.where(at_or_after(F.col("binlog_seq"), F.col("binlog_pos"), F.col("mark_seq"), F.col("mark_pos")))


def now_consistent(log: DataFrame) -> DataFrame:
    """FL4, ST5: tables that have an event at or behind their watermark: from there on they are consistent."""
    return past_watermark(log.where("mark_seq is not null")).select("source", "schema_name", "table_name").distinct()


def listed(log: DataFrame, sources: DataFrame, names: str = "log_tables") -> DataFrame:
    """FL8: events whose table is in their source's array of names."""
    return log.join(sources.select("source", names), "source").where(F.array_contains(names, F.col("table_name"))).drop(names)
