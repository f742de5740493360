"""The change log: its schema, row images, and sources that give it (section 1.4, SC1, SC5, SC7-SC12, PJ8, PJ9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.coordinates import log_number

# What a feed's settings must be.
FEED = {"log_bin": "ON", "binlog_format": "ROW", "binlog_row_image": "FULL"}
_TEXT, _LONG = T.StringType(), T.LongType()
SCHEMA = T.StructType(
    [
        T.StructField("event_id", _LONG),
        T.StructField("batch_id", _LONG),
        T.StructField("source", _TEXT),
        T.StructField("schema_name", _TEXT),
        T.StructField("table_name", _TEXT),
        T.StructField("op", _TEXT),  # insert, update, delete or ddl
        T.StructField("binlog_name", _TEXT),
        T.StructField("binlog_seq", T.IntegerType()),
        T.StructField("binlog_pos", _LONG),
        T.StructField("event_time", _LONG),  # epoch seconds
        T.StructField("after", _TEXT),  # JSON
        T.StructField("before", _TEXT),
        T.StructField("ddl", _TEXT),
    ]
)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A change log kept as Parquet; binlog_seq is derived where it is missing."""
    return _with_seq(spark.read.schema(SCHEMA).parquet(path))


def _with_seq(log: DataFrame) -> DataFrame:
    return log.withColumn("binlog_seq", F.coalesce("binlog_seq", log_number(F.col("binlog_name"))))


def stream_log(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """SC5, ST3: the same as a stream; a batch takes up to ``max_files`` new files."""
    return _with_seq(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path))


def image(text: Column, kind: T.StructType) -> Column:
    """A row image as its table's struct. Decimals and long numbers keep their digits; of equal keys the last counts."""
    return F.from_json(text, kind, {"mode": "PERMISSIVE", "prefersDecimal": "true"})


def bad_image(text: Column, read: Column, kind: T.StructType) -> Column:
    """SK3: whether an image isn't an object, or has a set field that ``read``, its struct, has not. False for no image."""
    raw = F.from_json(text, "map<string,string>")
    lost = F.lit(False)
    for f in kind.fields:
        lost = lost | (F.element_at(raw, f.name).isNotNull() & read[f.name].isNull())
    return text.isNotNull() & (raw.isNull() | F.coalesce(lost, F.lit(False)))


def not_allowed(read: Column, kind: T.StructType) -> Column:
    """DG9: whether ``read``, an image's struct, has a value that its enum column doesn't list."""
    found = F.lit(False)
    for f in kind.fields:
        if "allowed" in f.metadata:
            found = found | F.coalesce(~read[f.name].isin(f.metadata["allowed"]), F.lit(False))
    return found


def type_map(columns: DataFrame) -> DataFrame:
    """SC12: columns (schema_name, table_name, column_name, type) as a map of names to types for each table."""
    return columns.groupBy("schema_name", "table_name").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("column_name", "type")))).alias("types"))


def index_constraints(indexes: DataFrame, constraints: DataFrame) -> DataFrame:
    """JN9: each index (table_name, index_name) with the constraint that it backs, null if none."""
    return indexes.join(constraints.select("table_name", "index_name", "constraint_name"), ["table_name", "index_name"], "left")


def feed_problems(settings: DataFrame) -> DataFrame:
    """FL16: settings (source, name, value) of a feed that rows can't be replayed from: each with what it should be."""
    wanted = F.create_map(*(F.lit(x) for pair in sorted(FEED.items()) for x in pair))
    want = F.element_at(wanted, F.lower("name"))
    return settings.where(want.isNotNull() & ~F.upper("value").eqNullSafe(want)).select("source", "name", "value", want.alias("wanted"))


def pairs(log: DataFrame, column: str = "after") -> DataFrame:
    """PJ8, PJ9: a row for each key of the image, with columns key and value; events without an image keep one row."""
    return log.select("*", F.explode_outer(F.from_json(F.col(column), "map<string,string>")).alias("key", "value"))


def read_table(spark: SparkSession, location: str | Mapping[str, str], columns: Sequence[str] | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """SC1, SC6: a table to copy: a Parquet path, or JDBC options. partition is (column, lower, upper, number of slices)."""
    if isinstance(location, str):
        found = spark.read.parquet(location)
    else:
        reader = spark.read.format("jdbc").options(**location)
        if partition:
            column, low, high, slices = partition
            reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(slices))
        found = reader.load()
    return found.select(*columns) if columns else found


def table_columns(df: DataFrame, schema_name: str, table_name: str) -> list[tuple[str, str, str, str]]:
    """SC8, SC11, SC12: (schema, table, column, type) of a table."""
    return [(schema_name, table_name, f.name, f.dataType.simpleString()) for f in df.schema.fields]


def foreign_keys(usage: DataFrame) -> DataFrame:
    """SC9, AG14: usage (constraint_name, table_name, column_name, referenced_table, referenced_column, position) as one row a constraint."""
    listed = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("position", c))), lambda s: s[c]), ",")
    return usage.groupBy("constraint_name", "table_name", "referenced_table").agg(listed("column_name").alias("columns"), listed("referenced_column").alias("referenced_columns"))


def indices(statistics: DataFrame) -> DataFrame:
    """SC10, AG12: statistics (table_name, index_name, non_unique, column_name, seq, sub_part) without indexes on parts of columns."""
    columns = F.transform(F.array_sort(F.collect_list(F.struct("seq", "column_name"))), lambda s: s["column_name"])
    grouped = statistics.groupBy("table_name", "index_name", "non_unique").agg(columns.alias("columns"), F.count_if(F.col("sub_part").isNotNull()).alias("parts"))
    return grouped.where("parts = 0").drop("parts")


def key_columns(constraints: DataFrame, attributes: DataFrame) -> DataFrame:
    """SC15: constraints (table_name, conkey array) with attributes (table_name, attnum, attname) as table_name and ordered columns."""
    places = constraints.select("table_name", F.posexplode("conkey").alias("place", "attnum"))
    return places.join(attributes, ["table_name", "attnum"]).groupBy("table_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "attname"))), lambda s: s["attname"]).alias("pkey"))
