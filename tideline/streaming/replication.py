"""Replication as a structured stream: new files of the log, a batch at a time, into the store (ST1-ST4, ST10, CT14).

The checkpoint holds what has been read; the store's batch table what has been
applied. A batch that comes again after a failure is found there and skipped.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideline.plans.engine import Replica
from tideline.sources.changelog import stream_log


def start_replica(replica: Replica, source: str, log_path: str, checkpoint: str, max_files: int = 100, once: bool = False) -> StreamingQuery:
    """CT14, ST9: the stream of one source. ``once`` takes what is there and ends; else it goes on until stopped.

    While the source is paused a batch waits; if it is stopped meanwhile, the batch ends the stream and comes again."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        while (state := replica._source(source))["paused"]:
            if state["status"] == "stopped":
                raise RuntimeError(f"source {source} was stopped while paused")
            time.sleep(replica.config.sources[source].sleep_loop)
        replica.replay_batch(source, batch, batch_id)

    if not once:
        replica._set(source, status="running")
    writer = stream_log(replica.spark, log_path, max_files).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    pause = replica.config.sources[source].sleep_loop
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{pause} seconds")).start()


def run_replica(replica: Replica, source: str, log_path: str, checkpoint: str, max_files: int = 100, rounds: int | None = None) -> int:
    """CT14, ST9: takes what is there, again and again, until the source's status is ``stopped``; returns the rounds taken.

    Status and pause are read between rounds from the catalog, so another process can stop or pause it."""
    replica._set(source, status="running")
    taken = 0
    while rounds is None or taken < rounds:
        state = replica._source(source)
        if state["status"] != "running":
            break
        if not state["paused"]:
            start_replica(replica, source, log_path, checkpoint, max_files, once=True).awaitTermination()
            taken += 1
            replica.maintain_if_due(source)
        time.sleep(replica.config.sources[source].sleep_loop)
    return taken


def stop_all_replicas(replica: Replica) -> None:
    """CT14: every source that runs stops after its round."""
    for row in replica.catalog("sources").where("status = 'running'").collect():
        replica.stop(row.source)


def stop_replica(replica: Replica, source: str, query: StreamingQuery) -> None:
    query.stop()
    replica.stop(source)
