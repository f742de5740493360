from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions import coordinates, types
from tideline.sources.changelog import image


def test_spark_types():
    assert types.spark_type("int") == T.IntegerType() and types.spark_type("int", "int(10) unsigned") == T.LongType()
    assert types.spark_type("bigint", "bigint unsigned") == T.DecimalType(20, 0)
    assert types.spark_type("decimal", precision=10, scale=2) == T.DecimalType(10, 2)
    with pytest.raises(ValueError):
        types.spark_type("hypercube")
    assert types.memory_bytes("300M") == 300 << 20 and types.slice_rows("1k", 100) == 10 and types.slice_rows("1k", None) == 1_000_000


def test_edge_values(spark):
    row = spark.range(1).select(
        types.no_zero_date(F.lit("0000-00-00 00:00:00")).alias("zero"), types.no_nul(F.lit("a\0b")).alias("nul"), types.csv_field(F.lit("NULL")).alias("text"), types.csv_field(F.lit(None)).alias("null"),
        types.typed(F.lit("12x"), "int", T.IntegerType()).alias("bad"), coordinates.log_number(F.lit("mysql-bin.000012")).alias("n"), coordinates.log_number(F.lit("odd")).alias("none"),
        image(F.lit('{"d": 1.10, "n": 12345678901234567890123, "d": 1.20}'), T.StructType.fromDDL("d decimal(5,2), n decimal(38,0)")).alias("img"),
    ).first()
    assert (row.zero, row.nul, row.text, row.null, row.bad, row.n, row.none) == (None, "ab", '"NULL"', "NULL", None, 12, None)
    assert str(row.img.d) == "1.20" and int(row.img.n) == 12345678901234567890123


def test_no_coordinate_on_empty(spark):
    empty = spark.createDataFrame([(None, 5)], "s int, p long")
    assert empty.agg(coordinates.last_coordinate(F.col("s"), F.col("p")).alias("c")).first().c is None
