"""Batches of the log: queues, eligibility, consistency, retention, clean-up (A5, A6, AG8, AG10, JN2, JN5, JN7, SL1, SL3, ST1, ST6, DM8-DM10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.coordinates import coordinate


def queues(log: DataFrame, by: str = "batch_id", event: str = "event_id", time: str = "event_time") -> DataFrame:
    """AG8, SL4: each batch's events as an array, by time and then id. A batch of no events has no queue (K)."""
    return log.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct(time, event))), lambda s: s[event]).alias("events"))


def head_tail(queue: Column, n: int) -> tuple[Column, Column]:
    """PJ14, SL3: the first n of a queue, and the rest."""
    return F.slice(queue, 1, n), F.slice(queue, n + 1, F.greatest(F.size(queue) - n, F.lit(0)))


def numbered(log: DataFrame, size: int, event: str = "event_id") -> DataFrame:
    """AG20, ST3: log with batch_id: events in runs of ``size`` by their id's place in the id space, without a global order."""
    return log.withColumn("batch_id", F.floor(F.col(event) / size).cast("long"))


def eligible(batches: DataFrame) -> DataFrame:
    """FL9: started and processed, not yet replayed."""
    return batches.where("started and processed and not replayed")


def next_batches(batches: DataFrame, events: DataFrame, by: str = "source") -> DataFrame:
    """JN2, SL1: for each source the oldest eligible batch that has a queue."""
    ready = eligible(batches).join(events.select("batch_id").distinct(), "batch_id", "left_semi")
    return ready.groupBy(by).agg(F.min_by("batch_id", F.struct("ts_created", "batch_id")).alias("batch_id"))


def open_coordinates(batches: DataFrame) -> DataFrame:
    """ST1, AG13: for each source the coordinate to read on from: that of its newest batch that isn't processed."""
    return batches.where("started and not processed").groupBy("source").agg(F.max_by(F.struct("batch_id", "binlog_name", "binlog_pos"), F.struct("ts_created", "batch_id")).alias("b")).select("source", "b.*")


def reached(batches: DataFrame, marks: DataFrame) -> DataFrame:
    """ST6, JN7, AG4: source, and whether its processed batches have reached its high watermark (seq, pos)."""
    last = batches.where("processed").groupBy("source").agg(F.max(coordinate(F.col("binlog_seq"), F.col("binlog_pos"))).alias("last"))
    mark = coordinate(F.col("mark_seq"), F.col("mark_pos"))
    return marks.join(last, "source", "left").select("source", F.coalesce(F.col("last") >= mark, F.lit(False)).alias("consistent"))


def replayed_out(batches: DataFrame, now: Column, keep: str = "1 day") -> DataFrame:
    """DM8, FL10: batches to keep: those not replayed, or replayed within ``keep`` (such as "1 day") of now."""
    return batches.where(~F.coalesce(F.col("replayed") & (now - F.col("ts_replayed") > F.expr(f"interval {keep}")), F.lit(False)))


def maintenance_due(sources: DataFrame, now: Column, every: str) -> DataFrame:
    """FL11: sources whose last maintenance is longer ago than ``every``; never counts as the epoch."""
    last = F.coalesce(F.col("last_maintenance"), F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
    return sources.where(now - last > F.expr(f"interval {every}"))


def without_unprocessed(log: DataFrame, batches: DataFrame) -> DataFrame:
    """DM9, ST10: a log without the events of batches that were begun but not finished, which are read again."""
    return log.join(batches.where("not processed").select("batch_id"), "batch_id", "left_anti")


def cascade(parents: DataFrame, children: DataFrame, on: list[str]) -> DataFrame:
    """DM10: children that still have a parent."""
    return children.join(parents.select(*on).distinct(), on, "left_semi")


def backlog(log: DataFrame, by: str = "source") -> DataFrame:
    """AG15: events that wait for each source."""
    return log.groupBy(by).agg(F.count("*").alias("n_events"))


def pause_gate(sources: DataFrame, received: DataFrame, replayed: DataFrame) -> DataFrame:
    """JN5, ST9: source and whether it waits: it has received what isn't replayed yet. Sources that lack either are left out."""
    return sources.join(received, "source").join(replayed, "source").select("source", (F.col("received") > F.col("replayed")).alias("waits"))
