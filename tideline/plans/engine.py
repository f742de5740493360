"""A replica: snapshots, replay of log batches, DDL, errors, control (CT6-CT16, SC1, SC4, SK1-SK11, SK14, ER1-ER6, ST4-ST6, ST9, ST10)."""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.functions.types import spark_type, typed
from tideline.operators import batches, replay, routing, tables
from tideline.plans.evolve import apply_statement
from tideline.plans.store import Store
from tideline.sources import ddl
from tideline.sources.changelog import bad_image, image, not_allowed, read_table
from tideline.sources.config import Config, TableRules, duplicate_destinations

CATALOG = "_catalog"
VERSION = 1
#: Tables of an epoch that are replayed at a time.
ABREAST = 8
STATES = ("ready", "initialising", "initialised", "syncing", "synced", "running", "stopped", "error")
#: The catalog's tables.
TABLES = {
    "sources": "source string, schema_mappings map<string,string>, status string, binlog_seq int, binlog_pos long, consistent boolean, paused boolean, type string",
    "replica_tables": "source string, schema_name string, table_name string, destination string, pkey array<string>, binlog_seq int, binlog_pos long, enabled boolean",
    "batches": "batch_id long, source string, replayed long, skipped long, ddl long, last_time long",
    "error_log": "batch_id long, source string, schema_name string, table_name string, pkey string, event_id long, message string",
    "discarded_rows": "batch_id long, source string, schema_name string, table_name string, event_id long, row_data string",
}
KEYS = {"error_log": ["source", "schema_name", "table_name", "event_id"], "discarded_rows": ["source", "schema_name", "table_name", "event_id", "row_data"], "sources": ["source"], "replica_tables": ["source", "schema_name", "table_name"], "batches": ["source", "batch_id"]}


#: Of each column of a table its type and full type at the origin.
Types = Mapping[str, tuple[str, str]]


class Replica:
    """Commands over a configuration and a root folder; all state is in the store."""

    def __init__(self, spark: SparkSession, config: Config, root: str) -> None:
        self.spark, self.config, self.store = spark, config, Store(spark, root)
        self._putting = threading.RLock()

    # Catalog

    def create_schema(self) -> None:
        """CT6: the catalog's tables, empty; what exists stays."""
        for name, kind in TABLES.items():
            if not self.store.exists(f"{CATALOG}.{name}"):
                self.store.write(f"{CATALOG}.{name}", self.spark.createDataFrame([], kind), {"version": VERSION})

    def drop_schema(self) -> None:
        for name in TABLES:
            self.store.drop(f"{CATALOG}.{name}")

    def version(self) -> int | None:
        return self.store.info(f"{CATALOG}.sources").get("version")

    def catalog(self, name: str) -> DataFrame:
        return self.store.read(f"{CATALOG}.{name}")

    def _put(self, name: str, rows: list[tuple] | DataFrame) -> None:
        frame = rows if isinstance(rows, DataFrame) else self.spark.createDataFrame(rows, TABLES[name])
        with self._putting:  # tables are replayed side by side
            old = self.catalog(name)
            self.store.write(f"{CATALOG}.{name}", tables.upsert(old, frame, KEYS[name]) if name in KEYS else old.unionByName(frame))

    def _source(self, name: str) -> dict:
        found = self.catalog("sources").where(F.col("source") == name).first()
        if found is None:
            raise KeyError(f"source {name} isn't registered")
        return found.asDict()

    def _set(self, source: str, **values: object) -> None:
        row = self._source(source) | values
        if row["status"] not in STATES:
            raise ValueError(f"no such status: {row['status']}")
        self._put("sources", [tuple(row[f] for f in StructType.fromDDL(TABLES["sources"]).names)])

    def add_source(self, name: str) -> None:
        """CT7: a source of the configuration is registered; its destinations must be mapped once over all sources."""
        source = self.config.sources[name]
        known = {r.source: dict(r.schema_mappings) for r in self.catalog("sources").collect() if r.source != name}
        twice = duplicate_destinations(known | {name: dict(source.schema_mappings)})
        if twice:
            raise ValueError(f"destinations are mapped more than once: {', '.join(twice)}")
        self._put("sources", [(name, dict(source.schema_mappings), "ready", None, None, False, False, source.type)])

    def drop_source(self, name: str) -> None:
        """CT7, DM10: the source and all that hangs on it."""
        gone = self.spark.createDataFrame([(name,)], "source string")
        for table in TABLES:
            self.store.write(f"{CATALOG}.{table}", tables.without(self.catalog(table), gone, ["source"]))

    def update_schema_mappings(self, name: str) -> None:
        """CT8: destinations renamed as the configuration now maps them."""
        old, new = dict(self._source(name)["schema_mappings"]), dict(self.config.sources[name].schema_mappings)
        for origin, destination in new.items():
            if origin in old and old[origin] != destination:
                self.store.rename_schema(old[origin], destination)
        self._set(name, schema_mappings=new)
        moved = self.catalog("replica_tables")
        lookup = F.create_map(*(F.lit(x) for p in sorted(new.items()) for x in p))
        self.store.write(f"{CATALOG}.replica_tables", moved.withColumn("destination", F.when(F.col("source") == name, F.element_at(lookup, F.col("schema_name"))).otherwise(F.col("destination"))))

    # Snapshots

    def init_replica(self, name: str, locations: Mapping[str, str | Mapping[str, str]], keys: Mapping[str, list[str]], at: tuple[int, int], only: str | None = None, types: Mapping[str, Types] | None = None) -> list[str]:
        """CT9, SC4, SK9: tables copied as of a coordinate and published together; returns their names.

        locations, keys and types are by ``schema.table``. Tables without a key are copied but not replicated (K). A table
        with types has its columns converted from the origin's texts, by the overrides too (PJ1, DG13); rows that can't
        be are discarded (SK3, SK6). With keep_existing_schema a table that exists keeps its columns' types (SK8).
        """
        source = self.config.sources[name]
        mapping, rules = dict(self._source(name)["schema_mappings"]), TableRules.of(source, only)
        self._set(name, status="initialising" if only is None else "syncing")
        staged, rows, lost = [], [], []
        try:
            for full, location in sorted(locations.items()):
                schema, _, table = full.partition(".")
                if schema not in mapping or not rules.keeps(schema, table):
                    continue
                pkey = list(keys.get(full, ()))
                copied = read_table(self.spark, location)
                if types and full in types:
                    copied, bad = self._converted(copied, types[full], table)
                    lost.append(bad.select(F.lit(None).cast("long").alias("batch_id"), F.lit(name).alias("source"), F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), F.lit(None).cast("long").alias("event_id"), "row_data"))
                elif source.keep_existing_schema and self.store.exists(f"{mapping[schema]}.{table}"):
                    known = self.store.schema(f"{mapping[schema]}.{table}")
                    copied = copied.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in known.fields if f.name in copied.columns))
                staged.append(self.store.stage(f"{mapping[schema]}.{table}", copied, {"pkey": pkey, "enabled": bool(pkey), "fillfactor": self.config.fill_factor(full)}))
                rows.append((name, schema, table, mapping[schema], pkey, at[0], at[1], bool(pkey)))
        except Exception:
            for s in staged:
                self.store.discard(s)
            self._set(name, status="error")
            raise
        self.store.swap(staged)
        for bad in lost:
            self._put("discarded_rows", bad)
        self._put("replica_tables", rows)
        self._set(name, status="initialised" if only is None else "synced", binlog_seq=at[0], binlog_pos=at[1], consistent=False)
        return [s["table"] for s in staged]

    def _converted(self, rows: DataFrame, types: Types, table: str) -> tuple[DataFrame, DataFrame]:
        made, texts = {}, {}
        for column, (data_type, column_type) in types.items():
            found = re.search(r"\((\d+)(?:\s*,\s*(\d+))?\)", column_type)
            precision, scale = (int(x) if x else None for x in found.groups()) if found else (None, None)
            kind = spark_type(data_type, column_type, precision, scale, table, self.config.type_override)
            text = F.col(column).cast("string")
            texts[column] = F.when(~text.startswith("0000-00-00"), text) if data_type.lower() in ("date", "datetime", "timestamp") else text
            made[column] = typed(F.col(column), data_type, kind)
        return tables.good_and_bad(rows.select(*(texts[c].alias(c) for c in texts)), made)

    def sync_tables(self, name: str, only: str, locations: Mapping[str, str | Mapping[str, str]], keys: Mapping[str, list[str]], at: tuple[int, int]) -> list[str]:
        """CT9, CT10: some tables copied anew; ``disabled`` stands for those that errors have disabled."""
        if only == "disabled":
            off = self.catalog("replica_tables").where((F.col("source") == name) & ~F.col("enabled")).collect()
            only = ",".join(f"{r.schema_name}.{r.table_name}" for r in off)
            if not only:
                return []
        return self.init_replica(name, locations, keys, at, only)

    refresh_schema = init_replica

    def copy_schema(self, name: str, statements: str, schema: str) -> list[str]:
        """CT11: structure only, from CREATE TABLE statements."""
        destination = dict(self._source(name)["schema_mappings"])[schema]
        return [s.name for s in ddl.parse(statements) if apply_statement(self.store, destination, s, self.config.type_override) == "created"]

    # Replay

    def replay_batch(self, name: str, log: DataFrame, batch_id: int) -> dict[str, int]:
        """One batch of the log applied (ST4): idempotent by batch id, so a batch that comes again does nothing (ST10).

        Order: routing and filters, epochs between DDL, fold of each table, publication, then the batch's record.
        """
        done = self.catalog("batches").where((F.col("source") == name) & (F.col("batch_id") >= batch_id)).limit(1).count()
        if done:
            return {"replayed": 0, "skipped": 0, "ddl": 0}
        source, state = self.config.sources[name], self._source(name)
        if state["paused"]:
            raise RuntimeError(f"source {name} is paused")
        mapping = dict(state["schema_mappings"])
        rules = TableRules.of(source)
        kept = routing.mapped(log.where(F.col("source") == name), mapping).where(routing.table_filter(rules)).where(routing.skip_events(source.skip_events))
        kept = kept.drop("batch_id").withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        try:
            return self._replay(name, kept, batch_id, source.on_error_replay)
        finally:
            kept.unpersist()

    def _replay(self, name: str, kept: DataFrame, batch_id: int, on_error: str) -> dict[str, int]:
        """What is applied of a batch is kept with each table (``applied``, ``ddl``), so a batch that failed goes on where it was.

        With ``exit`` all tables are applied up to the first conflict of any, which ends the replay; the batch's record
        isn't written, so a later try stops there again until the table is copied anew. An epoch's tables go side by side.
        """
        total, n_ddl = kept.count(), 0
        touched = [(r.schema_name, r.table_name, r.destination) for r in kept.where("op <> 'ddl'").select("schema_name", "table_name", "destination").distinct().collect()]
        statements = kept.where("op = 'ddl'").select("event_id", "schema_name", "destination", "ddl").orderBy("event_id").collect()  # DDL is rare and applied on the driver
        replayed = sum(self._applied(f"{d}.{t}", batch_id).get("n", 0) for _, t, d in touched)
        end = (kept.agg(F.max("event_id")).first()[0] or 0) + 1
        begin = None
        for stop, statement in zip([*(s.event_id for s in statements), end], [*statements, None], strict=True):
            epoch = kept.where((F.lit(True) if begin is None else F.col("event_id") > begin) & (F.col("event_id") < stop))
            failure = None
            if on_error == "exit":
                probed = self._abreast(touched, lambda t, log=epoch, upto=stop: self._table(name, log, *t, batch_id, upto, probe=True)[1])
                failure = min(filter(None, probed), key=lambda f: f["event_id"], default=None)
                if failure:
                    stop, statement = failure["event_id"], None
                    epoch = epoch.where(F.col("event_id") < stop)
            replayed += sum(self._abreast(touched, lambda t, log=epoch, upto=stop: self._table(name, log, *t, batch_id, upto)[0]))
            if failure:
                self._put("error_log", [tuple(failure[f] for f in StructType.fromDDL(TABLES["error_log"]).names)])
                self._set(name, status="error")
                raise RuntimeError(f"replay of {failure['schema_name']}.{failure['table_name']} failed at event {stop}")
            if statement is not None:
                parsed = ddl.parse(statement.ddl or "")
                for k, each in enumerate(parsed):
                    n_ddl += self._ddl(name, statement.schema_name, statement.destination, each, [statement.event_id, k]) != "ignored"
                touched += [t for t in ((statement.schema_name, getattr(p, "to", None) or getattr(p, "name", ""), statement.destination) for p in parsed) if t[1] and t not in touched]
                begin = stop
        skipped = total - len(statements) - replayed
        last = kept.agg(F.max_by("event_time", "event_id")).first()[0]
        self._consistent(name, kept.agg(F.max(F.struct("binlog_seq", "binlog_pos"))).first()[0])
        self._put("batches", [(batch_id, name, replayed, skipped, n_ddl, last)])  # last, as it tells that all is done
        return {"replayed": replayed, "skipped": skipped, "ddl": n_ddl}

    def _abreast(self, found: Sequence[tuple], f: Callable[[tuple], object]) -> list:
        """f of each, some at a time. If one fails the others are still done; a later try goes on from there."""
        with ThreadPoolExecutor(ABREAST) as pool:
            begun = [pool.submit(inheritable_thread_target(self.spark)(f), each) for each in found]  # a wrapper, and properties, for each
        return [b.result() for b in begun]

    def _applied(self, full: str, batch_id: int) -> dict:
        found = self.store.info(full).get("applied", {})
        return found if found.get("batch") == batch_id else {}

    def _ddl(self, name: str, schema: str, destination: str, statement: ddl.Statement, event: list[int]) -> str:
        """DG1, K: what a DDL statement does to the store and to the registration of its table; nothing if it is done already."""
        table = getattr(statement, "name", "")
        mark = self.store.info(f"{destination}.{table}").get("ddl", [-1, -1]) if table else [-1, -1]
        if mark > event:
            return "ignored"
        done = "ignored" if mark == event else apply_statement(self.store, destination, statement, self.config.type_override)
        target = statement.to if isinstance(statement, ddl.RenameTable) else table
        if done not in ("ignored", "dropped"):
            self.store.note(f"{destination}.{target}", ddl=event)
        if isinstance(statement, (ddl.CreateTable, ddl.RenameTable)) and self.store.exists(f"{destination}.{target}"):
            own = (F.col("source") == name) & (F.col("schema_name") == schema) & (F.col("table_name") == target)
            if done != "ignored" or self.catalog("replica_tables").where(own).isEmpty():  # a try before may have ended in between
                pkey = self.store.info(f"{destination}.{target}").get("pkey", [])
                self._put("replica_tables", [(name, schema, target, destination, pkey, None, None, bool(pkey))])
        elif done == "disabled" or (mark == event and isinstance(statement, ddl.DropPrimaryKey)):
            self._put("replica_tables", [(name, schema, table, destination, [], None, None, False)])
        return done

    def _disable(self, known: Row, failure: dict) -> None:
        self._put("error_log", [tuple(failure[f] for f in StructType.fromDDL(TABLES["error_log"]).names)])
        self._put("replica_tables", [tuple((known.asDict() | {"enabled": False})[f] for f in StructType.fromDDL(TABLES["replica_tables"]).names)])

    def _table(self, name: str, log: DataFrame, schema: str, table: str, destination: str, batch_id: int, upto: int, probe: bool = False) -> tuple[int, dict | None]:
        """One table's events of an epoch, up to the event ``upto``: how many were applied, and its first conflict.

        ``probe`` only looks for the conflict. Images that can't be read go to discarded_rows.
        """
        full = f"{destination}.{table}"
        known = self.catalog("replica_tables").where((F.col("source") == name) & (F.col("schema_name") == schema) & (F.col("table_name") == table)).first()
        if known is None or not known.enabled or not self.store.exists(full):
            return 0, None
        info, done = self.store.info(full), self._applied(full, batch_id)
        if done.get("failure"):
            self._disable(known, done["failure"])  # the last try ended before this
            return 0, None
        events = log.where((F.col("schema_name") == schema) & (F.col("table_name") == table) & (F.col("op") != "ddl") & (F.col("event_id") >= done.get("upto", -(1 << 62))))
        events = routing.past_watermark(events.withColumns({"mark_seq": F.lit(known.binlog_seq).cast("int"), "mark_pos": F.lit(known.binlog_pos).cast("long")}))
        base, key = self.store.read(full), list(known.pkey)
        rows = StructType([f for f in base.schema.fields])
        read = events.withColumn("_a", image(F.col("after"), rows)).withColumn("_b", image(F.col("before"), rows))
        bad_after, bad_before = (bad_image(F.col(text), F.col(read), rows) for text, read in (("after", "_a"), ("before", "_b")))
        no_after = F.col("after").isNull()
        bad_after = bad_after | ((F.col("op") != "delete") & not_allowed(F.col("_a"), rows))
        bad = F.when(F.col("op") == "delete", F.when(F.col("before").isNull(), no_after | bad_after).otherwise(bad_before)).otherwise(no_after | bad_after | ((F.col("op") == "update") & bad_before))
        read = read.withColumn("_bad", bad).persist()
        values = [c for c in rows.names if c not in key]
        at, op = "_event_", "_kind_"  # tables may have columns of the log's names
        good = read.where("not _bad")
        flat = good.select(F.col("event_id").alias(at), F.col("op").alias(op), *(F.coalesce(F.col(f"_a.`{c}`"), F.when((F.col("op") == "delete") & no_after, F.col(f"_b.`{c}`"))).alias(c) for c in rows.names), *(F.coalesce(F.col(f"_b.`{k}`"), F.col(f"_a.`{k}`")).alias(f"_before_{k}") for k in key))
        flat, old = flat.persist(), [f"_before_{k}" for k in key]
        keys = flat.select(*key).unionByName(flat.select(*(F.col(b).alias(k) for b, k in zip(old, key, strict=True)))).distinct()
        there = base.select(*key).join(keys, key, "left_semi").persist()  # all that a batch asks of the table: which of its keys are there
        events_of = flat
        try:
            if not probe:
                lost = read.where("_bad").select(F.lit(batch_id).cast("long").alias("batch_id"), "source", "schema_name", "table_name", "event_id", F.lower(F.hex(F.coalesce("after", "before", F.lit("")))).alias("row_data"))
                if not lost.isEmpty():
                    self._put("discarded_rows", lost)
            events_of = replay.split_key_changes(replay.settle_key_changes(flat, key, old, there, op, at), key, old, op, at).drop(*old).persist()
            whole = f"{op} <> 'insert' or {at} % 2 = 0"  # the second half of a key change isn't counted
            n = events_of.where(whole).count()
            if not n:
                return 0, None
            table_of = events_of.withColumn("_table", F.lit(table))
            clash = replay.conflicts(table_of, ["_table", *key], there.withColumn("_table", F.lit(table)), op, at)
            first = replay.errors(clash, ["_table"], key, at).first()
            failure = None
            if first is not None:
                failure = {"batch_id": batch_id, "source": name, "schema_name": schema, "table_name": table, "pkey": first.pkey, "event_id": first[at] // 2, "message": first.message}
                events_of = events_of.where(F.col(at) < failure["event_id"] * 2)  # a move that clashes leaves the old row, too
                n = events_of.where(whole).count()
            if not probe:
                applied = {"batch": batch_id, "upto": upto, "n": done.get("n", 0) + n, "failure": failure}
                delta = replay.changed(events_of, key, values, there, op, at)
                self.store.append(full, delta.select(F.struct(*rows.names).alias("row"), F.col("_gone").alias("gone")), key, info | {"applied": applied})
                if failure:
                    self._disable(known, failure)
            return n, failure
        finally:
            for frame in (events_of, there, flat, read):
                frame.unpersist()

    def _consistent(self, name: str, mark: object) -> None:
        """ST6: once a batch reaches the source's high watermark, its tables need no watermark any more."""
        state = self._source(name)
        if state["consistent"] or mark is None or (state["binlog_seq"] is not None and (mark["binlog_seq"], mark["binlog_pos"]) < (state["binlog_seq"], state["binlog_pos"])):
            return
        self._set(name, consistent=True)
        rows = self.catalog("replica_tables")
        own = F.col("source") == name
        self.store.write(f"{CATALOG}.replica_tables", rows.withColumns({c: F.when(~own, F.col(c)) for c in ("binlog_seq", "binlog_pos")}))

    # Control

    def pause(self, name: str) -> None:
        self._set(name, paused=True)

    def resume(self, name: str) -> None:
        self._set(name, paused=False)

    def enable_replica(self, name: str) -> None:
        self._set(name, status="initialised")

    def stop(self, name: str) -> None:
        self._set(name, status="stopped")

    def detach_replica(self, name: str) -> dict[str, int]:
        """CT12, SK14: the greatest key of each table with one integral key column; then the source goes."""
        out = {}
        for r in self.catalog("replica_tables").where(F.col("source") == name).collect():
            full = f"{r.destination}.{r.table_name}"
            if len(r.pkey) == 1 and self.store.exists(full) and self.store.read(full).schema[r.pkey[0]].dataType.simpleString() in ("int", "bigint"):
                out[full] = tables.sequence_values(self.store.read(full), r.pkey).first().last_value
        self.drop_source(name)
        return out

    def run_maintenance(self, name: str) -> int:
        """CT4, CT5: the source's tables are compacted and their old versions go."""
        self._retire(name)
        gone = 0
        for r in self.catalog("replica_tables").where(F.col("source") == name).collect():
            full = f"{r.destination}.{r.table_name}"
            if self.store.exists(full):
                self.store.compact(full)
                gone += self.store.vacuum(full)
        return gone

    def maintain_if_due(self, name: str, now: int | None = None) -> bool:
        """CT5, FL11: maintenance if the last one is longer ago than the source's auto_maintenance says."""
        every = self.config.sources[name].auto_maintenance
        if every == "disabled":
            return False
        now = int(time.time()) if now is None else now
        known = self.store.info(f"{CATALOG}.sources").get("maintained", {})
        at = lambda seconds: F.timestamp_seconds(F.lit(seconds)).cast("timestamp_ntz")
        last = self.spark.createDataFrame([(name,)], "source string").withColumn("last_maintenance", at(known.get(name, 0)))
        if batches.maintenance_due(last, at(now), every).isEmpty():
            return False
        self.run_maintenance(name)
        self.store.note(f"{CATALOG}.sources", maintained=known | {name: now})
        return True

    def validate_foreign_keys(self, keys: Sequence[tuple[str, str, Sequence[tuple[str, str]]]]) -> DataFrame:
        """CT2, CT12: child, parent and n, the child's rows without a parent, for each key (child, parent, pairs of columns) of stored tables."""
        found = self.spark.createDataFrame([], "child string, parent string, n long")
        for child, parent, on in keys:
            lost = tables.orphans(self.store.read(child), self.store.read(parent), on)
            found = found.unionByName(lost.agg(F.count("*").alias("n")).select(F.lit(child).alias("child"), F.lit(parent).alias("parent"), "n"))
        return found

    def _retire(self, name: str) -> None:
        """FL10, DM8: records of batches older than batch_retention go; the newest stays, as it tells what is done."""
        known = self.catalog("batches")
        newest = known.where(F.col("source") == name).agg(F.max("batch_id")).first()[0]
        age = F.make_interval(secs=F.lit(int(time.time())) - F.col("last_time"))
        old = (F.col("source") == name) & (F.col("batch_id") < F.lit(newest).cast("long")) & (F.timestamp_seconds(F.lit(0)) + age > F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {self.config.sources[name].batch_retention}"))
        self.store.write(f"{CATALOG}.batches", known.where(~F.coalesce(old, F.lit(False))))

    # Reports

    def show_status(self) -> DataFrame:
        seen = self.catalog("batches").groupBy("source").agg(F.max("last_time").alias("last_time"), F.sum("replayed").alias("replayed"), F.sum("skipped").alias("skipped"), F.sum("ddl").alias("ddl"))
        lag = F.lit(int(time.time())) - F.col("last_time")
        return self.catalog("sources").join(seen, "source", "left").select("source", "type", "status", "consistent", "paused", "replayed", "skipped", "ddl", lag.alias("lag"))

    def show_tables(self) -> DataFrame:
        kinds = [("not replicated", ~F.col("enabled")), ("replicated", F.col("enabled")), ("all", F.lit(True))]
        return tables.status_counts(self.catalog("replica_tables"), kinds, F.concat_ws(".", "schema_name", "table_name"))

    def show_errors(self) -> DataFrame:
        return self.catalog("error_log").join(self.catalog("sources").select("source", "status"), "source", "left")

    def show_sources(self) -> DataFrame:
        return self.catalog("sources").select("source", "type", "schema_mappings", "status")

    def show_config(self) -> Config:
        return self.config


