"""Tables of metadata and of state: upserts, mappings, checks (DM4-DM7, AG10-AG12, AG17, SO1, SO2, CT2, CT3, JN8-JN11, FL8, FL12, FL13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """DM4-DM6: table with rows put in; a row of an equal key is replaced as a whole. Of equal keys in rows one stays."""
    rest = [c for c in table.columns if c not in key]
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.select(*table.columns).withColumn("_new", F.lit(1)))
    kept = both.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct("_new", *[F.xxhash64(F.to_json(F.struct(*rest))).alias("_tie")])).alias("_row"))
    return kept.select(*(F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in table.columns))


def updated(table: DataFrame, changes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """JN11, DM7: table with the columns of the rows that changes name set to its values."""
    new = changes.select(*key, *(F.col(c).alias(f"_new_{c}") for c in columns)).withColumn("_hit", F.lit(True))
    joined = table.join(new, list(key), "left")
    return joined.select(*(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns))


def without(table: DataFrame, gone: DataFrame, key: Sequence[str]) -> DataFrame:
    """FL12: table without the rows whose key is in ``gone``."""
    return table.join(gone.select(*key).distinct(), list(key), "left_anti")


def mappings(sources: DataFrame) -> DataFrame:
    """A2, JN6: source, origin and destination of each schema mapping."""
    return sources.select("source", F.explode("schema_mappings").alias("origin", "destination"))


def duplicate_destinations(*pairs: DataFrame) -> DataFrame:
    """SO1, AG11: destinations that occur more than once in all the mappings, with their number."""
    every = pairs[0].select("destination")
    for p in pairs[1:]:
        every = every.unionByName(p.select("destination"))
    return every.groupBy("destination").agg(F.count("*").alias("n")).where("n > 1")


def status_counts(tables: DataFrame, kinds: Sequence[tuple[str, Column]], name: Column) -> DataFrame:
    """AG10, SO2, SL7: for each kind (label, condition) a row of label, number and names (null if none), in order. One scan."""
    found = tables.agg(*(F.struct(F.count_if(c).alias("n"), F.array_sort(F.collect_list(F.when(c, name))).alias("names")).alias(f"k{i}") for i, (_, c) in enumerate(kinds)))
    rows = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(label).alias("status"), F.col(f"k{i}.n").alias("n"), F.when(F.col(f"k{i}.n") > 0, F.col(f"k{i}.names")).alias("names")) for i, (label, _) in enumerate(kinds)))
    return found.select(F.explode(rows).alias("r")).select("r.*").orderBy("i").drop("i")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """CT2: rows of child whose set foreign key isn't in parent."""
    named = parent.select(*(F.col(p).alias(c) for c, p in on)).distinct()
    keys = [c for c, _ in on]
    return child.where(" and ".join(f"`{c}` is not null" for c in keys)).join(named, keys, "left_anti")


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """CT3: keys that more than one row has, with their number."""
    return table.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def null_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """CT3: rows that lack a part of their key; the file format doesn't enforce NOT NULL."""
    return table.where(" or ".join(f"`{c}` is null" for c in key))


def sequence_values(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SK14, AG17: the greatest value of each serial column, a row each."""
    greatest = table.agg(*(F.max(c).alias(c) for c in columns))
    return greatest.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("last_value")) for c in columns))).alias("r")).select("r.*")


def serials(columns: DataFrame) -> DataFrame:
    """FL15: columns (with column_default) that a sequence fills."""
    return columns.where(F.col("column_default").like("nextval%"))


def active(sources: DataFrame) -> DataFrame:
    """FL13: sources that are neither ready nor stopped nor in any other state of rest."""
    return sources.where(~F.col("status").isin("ready", "initialised", "synced", "stopped", "error"))


def good_and_bad(rows: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """SK3, SK6, H9: rows converted, and those in which a set value couldn't be, with the row as hex of its JSON.

    ``columns`` gives the conversion of each column; one that turns a set value into null has failed.
    """
    failed = F.lit(False)
    for name, made in columns.items():
        failed = failed | (F.col(name).isNotNull() & made.isNull())
    good = rows.where(~failed).withColumns(columns)
    return good, rows.where(failed).select("*", F.lower(F.hex(F.to_json(F.struct("*")))).alias("row_data"))
