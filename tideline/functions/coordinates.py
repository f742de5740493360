"""Log coordinates and transaction sets as column expressions (A7, A8, AG1, AG2, AG4, PJ12, PJ13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_number(name: Column) -> Column:
    """PJ12: the integer suffix of a log file's name, ``mysql-bin.000012`` -> 12; null if there is none."""
    return F.try_to_number(F.split_part(name, F.lit("."), F.lit(2)), F.lit("999999999")).cast("int")


def coordinate(seq: Column, pos: Column) -> Column:
    """A7: a struct that orders by file, then position; null if either part is, so that aggregates leave it out."""
    return F.when(seq.isNotNull() & pos.isNotNull(), F.struct(seq.cast("int").alias("seq"), pos.cast("long").alias("pos")))


def last_coordinate(seq: Column, pos: Column) -> Column:
    """AG1, AG4: the greatest coordinate of a group; null for an empty one (positions stay 64-bit)."""
    return F.max(coordinate(seq, pos))


def first_coordinate(seq: Column, pos: Column) -> Column:
    """AG2: the least coordinate of a group."""
    return F.min(coordinate(seq, pos))


def at_or_after(seq: Column, pos: Column, mark_seq: Column, mark_pos: Column) -> Column:
    """FL4: whether a coordinate has reached a mark; true where there is no mark."""
    mark = coordinate(mark_seq, mark_pos)
    return mark.isNull() | F.coalesce(coordinate(seq, pos) >= mark, F.lit(False))


def transaction_sets(text: Column) -> Column:
    """A8: ``uuid:lo-hi`` parts, split at commas and line ends, as structs (uuid, lo, hi). A part without "-" has lo = hi."""
    parts = F.filter(F.transform(F.split(text, ","), F.trim), lambda p: p != "")
    span = lambda p: F.split_part(p, F.lit(":"), F.lit(2))
    low = lambda p: F.split_part(span(p), F.lit("-"), F.lit(1))
    high = lambda p: F.when(F.contains(span(p), F.lit("-")), F.split_part(span(p), F.lit("-"), F.lit(2))).otherwise(low(p))
    clean = F.transform(parts, lambda p: F.regexp_replace(p, "\\s", ""))
    return F.transform(clean, lambda p: F.struct(F.split_part(p, F.lit(":"), F.lit(1)).alias("uuid"), low(p).cast("long").alias("lo"), high(p).cast("long").alias("hi")))


def transaction_text(sets: Column) -> Column:
    """PJ13: structs (uuid, lo, hi) as text, parts joined by a comma and a line end."""
    return F.array_join(F.transform(sets, lambda s: F.concat(s["uuid"], F.lit(":"), s["lo"].cast("string"), F.lit("-"), s["hi"].cast("string"))), ",\n")
