"""A query for each operator over the test tables, with the same in SQL. Names follow section 7.6 of the survey.

``events`` serves as the change log: signup inserts, error deletes, the other
types update; user_id is the key, event_id the order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.functions import coordinates, types
from tideline.operators import batches, replay, reports, routing, tables
from tideline.plans import evolve
from tideline.plans.engine import Replica
from tideline.plans.store import work_folder
from tideline.sources import changelog, ddl
from tideline.sources.config import Config, Source, TableRules
from tideline.streaming.replication import start_replica

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(ts: Column) -> Column:
    return types.epoch_seconds(ts.cast("timestamp_ntz"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a change log."""
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    named = F.when(F.col("user_id") % 3 == 0, "orders").when(F.col("user_id") % 3 == 1, "items").otherwise("people")
    return _read(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "props", op.alias("op"), named.alias("table_name"),
        F.when(F.col("user_id") % 2 == 0, "shop").otherwise("crm").alias("schema_name"), F.when(F.col("user_id") % 2 == 0, "east").otherwise("west").alias("source"),
        F.floor(F.col("event_id") / 1000).cast("long").alias("batch_id"), F.floor(F.col("event_id") / 2500).cast("int").alias("binlog_seq"),
        ((F.col("event_id") % 2500) * 100).cast("long").alias("binlog_pos"), _seconds(F.col("ts")).alias("event_time"),
    )


LOG = """WITH log AS (SELECT event_id, user_id, value, props, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
  CASE user_id % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'items' ELSE 'people' END AS table_name, CASE user_id % 2 WHEN 0 THEN 'shop' ELSE 'crm' END AS schema_name,
  CASE user_id % 2 WHEN 0 THEN 'east' ELSE 'west' END AS source, CAST(event_id // 1000 AS BIGINT) AS batch_id, CAST(event_id // 2500 AS INTEGER) AS binlog_seq,
  CAST((event_id % 2500) * 100 AS BIGINT) AS binlog_pos, CAST(date_diff('second', TIMESTAMP '1970-01-01', date_trunc('second', ts)) AS BIGINT) AS event_time FROM events)
"""


@query(LOG + """, folded AS (SELECT user_id, arg_max(op, event_id) FILTER (op <> 'update') AS last_op, arg_max(value, event_id) AS value, arg_max(props, event_id) AS props, max(event_id) AS event_id FROM log GROUP BY user_id)
SELECT user_id, event_id, value, props FROM folded WHERE last_op = 'insert'""")
def fold_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM1-DM3, SL2."""
    log = _log(spark, sf_dir).withColumn("id", F.col("event_id"))
    return replay.fold(log, ["user_id"], ["id", "value", "props"]).withColumnRenamed("id", "event_id")


@query(LOG + """, base AS (SELECT c_custkey AS user_id, c_acctbal AS value FROM customer), folded AS (SELECT user_id, arg_max(op, event_id) FILTER (op <> 'update') AS last_op, arg_max(value, event_id) AS value FROM log GROUP BY user_id)
SELECT f.user_id, f.value FROM folded f LEFT JOIN base b ON f.user_id = b.user_id WHERE last_op = 'insert' OR (last_op IS NULL AND b.user_id IS NOT NULL)
UNION ALL SELECT user_id, value FROM base WHERE user_id NOT IN (SELECT user_id FROM folded)""")
def fold_on_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM1-DM3 on a base table: updates of rows that it has, inserts, deletes."""
    base = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("value"))
    return replay.fold(_log(spark, sf_dir), ["user_id"], ["value"], base)


@query(LOG + """, turns AS (SELECT *, lag(op) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM log WHERE op IN ('insert', 'delete'))
SELECT event_id, user_id FROM turns WHERE op = 'insert' AND before = 'insert'""")
def insert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT3, ER1."""
    return replay.conflicts(_log(spark, sf_dir), ["user_id"]).select("event_id", "user_id")


CUT = LOG + """, turns AS (SELECT *, lag(op) OVER (PARTITION BY table_name, user_id ORDER BY event_id) AS before FROM log WHERE op IN ('insert', 'delete')),
clash AS (SELECT table_name, min(event_id) AS first FROM turns WHERE op = 'insert' AND before = 'insert' GROUP BY table_name)
"""


@query(CUT + "SELECT log.event_id, log.table_name, log.op FROM log LEFT JOIN clash USING (table_name) WHERE first IS NULL OR event_id < first")
def first_conflict_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER3: continue."""
    return replay.cut_at_conflict(_log(spark, sf_dir), ["user_id"], ["table_name"]).select("event_id", "table_name", "op")


@query(CUT + "SELECT event_id, table_name, op FROM log WHERE event_id < (SELECT coalesce(min(first), 1e18) FROM clash)")
def first_conflict_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER4: exit."""
    return replay.cut_at_exit(_log(spark, sf_dir), ["user_id"], ["table_name"]).select("event_id", "table_name", "op")


@query(CUT + """SELECT t.table_name, '"user_id"=''' || t.user_id || '''' AS pkey, t.event_id, 'duplicate key value' AS message FROM turns t JOIN clash c ON t.table_name = c.table_name AND t.event_id = c.first""")
def error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER2."""
    return replay.errors(replay.conflicts(_log(spark, sf_dir), ["table_name", "user_id"]), ["table_name"], ["user_id"])


@query("SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def lww_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SL2: the last event of each key."""
    return replay.latest(_read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value").withColumn("o", F.col("event_id")), ["user_id"], "o").drop("o")


@query("""WITH steps AS (SELECT event_id, unnest(CASE WHEN event_id % 7 = 0 AND event_type NOT IN ('signup', 'error') THEN [{'step': 0, 'op': 'delete'}, {'step': 1, 'op': 'insert'}]
  ELSE [{'step': 0, 'op': CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END}] END) AS s, user_id FROM events)
SELECT event_id * 2 + s.step AS event_id, s.op AS op, CASE WHEN s.op = 'delete' AND event_id % 7 = 0 AND event_id IN (SELECT event_id FROM events WHERE event_type NOT IN ('signup', 'error')) THEN user_id + 1000 ELSE user_id END AS user_id FROM steps""")
def key_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: updates that change the key as a delete and an insert."""
    log = _log(spark, sf_dir).withColumn("before_id", F.when((F.col("event_id") % 7 == 0) & (F.col("op") == "update"), F.col("user_id") + 1000).otherwise(F.col("user_id")))
    return replay.split_key_changes(log, ["user_id"], ["before_id"]).select("event_id", "op", "user_id")


@query("SELECT event_id, k.key AS key, k.value ->> '$' AS value FROM events, json_each(props) k")
def json_explode_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ8."""
    return changelog.pairs(_read(spark, sf_dir, "events").select("event_id", "props"), "props").select("event_id", "key", "value")


@query("SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events")
def json_typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ8, H2."""
    kind = StructType.fromDDL("k long")
    return _read(spark, sf_dir, "events").select("event_id", changelog.image(F.col("props"), kind)["k"].alias("k"))


@query("""SELECT l_orderkey, string_agg(DISTINCT '"l_linenumber"=' || '''' || l_linenumber || '''', ' AND ' ORDER BY '"l_linenumber"=' || '''' || l_linenumber || '''') AS predicate FROM lineitem GROUP BY l_orderkey""")
def pk_predicate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG6, PJ10."""
    text = F.concat(types.quoted_name(F.lit("l_linenumber")), F.lit("="), types.quoted_literal(F.col("l_linenumber").cast("string")))
    return _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(text)), " AND ").alias("predicate"))


@query(LOG + """SELECT event_id, CASE op WHEN 'insert' THEN 'INSERT INTO "' || table_name || '" ("user_id","props") VALUES (''' || user_id || ''',''' || props || ''')'
  WHEN 'update' THEN 'UPDATE "' || table_name || '" SET "user_id"=''' || user_id || ''',"props"=''' || props || ''' WHERE "user_id"=''' || user_id || ''''
  ELSE 'DELETE FROM "' || table_name || '" WHERE "user_id"=''' || user_id || '''' END AS statement FROM log""")
def changelog_render_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ10, AG5."""
    key = types.quoted_literal(F.col("user_id").cast("string"))
    names, values = F.array(types.quoted_name(F.lit("user_id")), types.quoted_name(F.lit("props"))), F.array(key, types.quoted_literal(F.col("props")))
    keys = F.array(F.concat(types.quoted_name(F.lit("user_id")), F.lit("="), key))
    return _log(spark, sf_dir).select("event_id", replay.statement_text(F.col("op"), types.quoted_name(F.col("table_name")), names, values, keys).alias("statement"))


MARKS = "SELECT o_custkey, CAST(o_orderkey % 13 AS INTEGER) AS seq, CAST(o_orderkey * 31 % 100000 AS BIGINT) AS pos FROM orders"


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 13).cast("int").alias("seq"), (F.col("o_orderkey") * 31 % 100000).cast("long").alias("pos"))


@query(f"SELECT o_custkey, max((seq, pos))[1] AS seq, max((seq, pos))[2] AS pos FROM ({MARKS}) GROUP BY o_custkey".replace("max((seq, pos))[1]", "arg_max(seq, seq::BIGINT * 1000000 + pos)").replace("max((seq, pos))[2]", "arg_max(pos, seq::BIGINT * 1000000 + pos)"))
def binlog_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1, AG4."""
    return _marks(spark, sf_dir).groupBy("o_custkey").agg(coordinates.last_coordinate(F.col("seq"), F.col("pos")).alias("c")).select("o_custkey", "c.*")


@query(f"SELECT o_custkey, arg_min(seq, seq::BIGINT * 1000000 + pos) AS seq, arg_min(pos, seq::BIGINT * 1000000 + pos) AS pos FROM ({MARKS}) GROUP BY o_custkey")
def binlog_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG2."""
    return _marks(spark, sf_dir).groupBy("o_custkey").agg(coordinates.first_coordinate(F.col("seq"), F.col("pos")).alias("c")).select("o_custkey", "c.*")


@query("SELECT o_orderkey, CAST(o_orderkey % 1000 AS INTEGER) AS seq FROM orders")
def log_file_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ12."""
    name = F.concat(F.lit("mysql-bin."), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 6, "0"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", coordinates.log_number(name).alias("seq"))


#: (table, mark_seq, mark_pos): people has no watermark.
WATERMARKS = [("orders", 1, 100_000), ("items", 2, 50_000), ("people", None, None)]


@query(LOG + "SELECT event_id, table_name FROM log WHERE table_name = 'people' OR (table_name = 'orders' AND (binlog_seq, binlog_pos) >= (1, 100000)) OR (table_name = 'items' AND (binlog_seq, binlog_pos) >= (2, 50000))")
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL4, ST7."""
    marks = spark.createDataFrame(WATERMARKS, "table_name string, mark_seq int, mark_pos long")
    return routing.past_watermark(_log(spark, sf_dir).join(marks, "table_name")).select("event_id", "table_name")


@query(LOG + "SELECT DISTINCT source, schema_name, table_name FROM log WHERE (table_name = 'orders' AND (binlog_seq, binlog_pos) >= (1, 100000)) OR (table_name = 'items' AND (binlog_seq, binlog_pos) >= (2, 50000))")
def now_consistent_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5."""
    marks = spark.createDataFrame(WATERMARKS, "table_name string, mark_seq int, mark_pos long")
    return routing.now_consistent(_log(spark, sf_dir).join(marks, "table_name"))


@query(LOG + """, last AS (SELECT source, max(binlog_seq * 1000000 + binlog_pos) AS last FROM log WHERE batch_id < 5 GROUP BY source), marks(source, mark) AS (VALUES ('east', 1100000), ('west', 9000000), ('north', 0))
SELECT m.source, coalesce(l.last >= m.mark, false) AS consistent FROM marks m LEFT JOIN last l ON m.source = l.source""")
def source_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST6, JN7."""
    marks = spark.createDataFrame([("east", 1, 100_000), ("west", 9, 0), ("north", 0, 0)], "source string, mark_seq int, mark_pos long")
    return batches.reached(_log(spark, sf_dir).withColumn("processed", F.col("batch_id") < 5), marks)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def limit_skip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL1, FL14, JN13 with lists of any size."""
    customer = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return routing.limit_skip(_read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), customer.where("c_mktsegment = 'BUILDING'"), customer.where("c_acctbal < 0"), ["o_custkey"])


@query(LOG + "SELECT event_id, schema_name, table_name FROM log WHERE NOT (schema_name = 'shop' AND table_name = 'people') AND (schema_name <> 'crm' OR table_name IN ('orders', 'items'))")
def table_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL1, FL3 with short lists."""
    rules = TableRules.of(Source("s", limit_tables=("crm.orders", "crm.items"), skip_tables=("shop.people",)))
    return _log(spark, sf_dir).where(routing.table_filter(rules)).select("event_id", "schema_name", "table_name")


@query(LOG + "SELECT event_id, op, schema_name, table_name FROM log WHERE NOT (op = 'insert' AND schema_name = 'shop' AND table_name = 'orders') AND NOT (op = 'delete' AND schema_name = 'crm')")
def skip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL2."""
    return _log(spark, sf_dir).where(routing.skip_events({"insert": ("shop.orders",), "delete": ("crm",)})).select("event_id", "op", "schema_name", "table_name")


@query("SELECT c_custkey, n_name, r_name, 'dw_' || lower(r_name) AS destination FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'AFRICA')")
def schema_mapping_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ7, FL6, JN1."""
    named = _read(spark, sf_dir, "customer").join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return routing.mapped(named, {"ASIA": "dw_asia", "EUROPE": "dw_europe", "AFRICA": "dw_africa"}, "r_name").select("c_custkey", "n_name", "r_name", "destination")


@query(LOG + "SELECT event_id, source, table_name, 'user_id' AS pkey FROM log WHERE (source = 'east' AND table_name = 'orders') OR (source = 'west' AND table_name = 'items')")
def registered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN1, FL7: events of enabled tables of their own source."""
    known = [("east", "shop", "orders", ["user_id"], None, None, True), ("west", "crm", "items", ["user_id"], None, None, True), ("west", "crm", "orders", ["user_id"], None, None, False), ("west", "shop", "people", ["user_id"], None, None, True)]
    found = spark.createDataFrame(known, "source string, schema_name string, table_name string, pkey array<string>, binlog_seq int, binlog_pos long, enabled boolean")
    return routing.registered(_log(spark, sf_dir), found).select("event_id", "source", "table_name", F.array_join("pkey", ",").alias("pkey"))


@query("SELECT destination, count(*) AS n FROM (SELECT n_regionkey::VARCHAR AS destination FROM nation UNION ALL SELECT r_regionkey::VARCHAR FROM region) GROUP BY destination HAVING count(*) > 1")
def duplicate_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG11, SO1, A2."""
    as_pairs = lambda t, c: _read(spark, sf_dir, t).select(F.col(c).cast("string").alias("destination"))
    return tables.duplicate_destinations(as_pairs("nation", "n_regionkey"), as_pairs("region", "r_regionkey"))


@query("""SELECT 'not replicated' AS status, count(*) FILTER (c_acctbal < 0) AS n, string_agg(c_name, ',' ORDER BY c_name) FILTER (c_acctbal < 0) AS names FROM customer
UNION ALL SELECT 'replicated', count(*) FILTER (c_acctbal >= 0), string_agg(c_name, ',' ORDER BY c_name) FILTER (c_acctbal >= 0) FROM customer
UNION ALL SELECT 'lost', count(*) FILTER (c_acctbal > 1e9), string_agg(c_name, ',' ORDER BY c_name) FILTER (c_acctbal > 1e9) FROM customer""")
def table_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG10, SO2, SL7."""
    kinds = [("not replicated", F.col("c_acctbal") < 0), ("replicated", F.col("c_acctbal") >= 0), ("lost", F.col("c_acctbal") > 1e9)]
    return tables.status_counts(_read(spark, sf_dir, "customer"), kinds, F.col("c_name")).withColumn("names", F.array_join("names", ","))


@query(LOG + "SELECT source, batch_id, count(*) FILTER (op <> 'delete' AND table_name <> 'people') AS n_replayed, count(*) FILTER (op <> 'delete' AND table_name = 'people') AS n_skipped, count(*) FILTER (op = 'delete') AS n_ddl FROM log GROUP BY source, batch_id")
def replica_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9, AG16, ER5, PJ11; deletes stand for DDL."""
    log = _log(spark, sf_dir).withColumn("op", F.when(F.col("op") == "delete", "ddl").otherwise(F.col("op")))
    return replay.counters(log, ["source", "batch_id"], F.col("table_name") == "people")


@query(LOG + "SELECT source, batch_id, arg_max(event_time, event_id) AS last_time FROM log GROUP BY source, batch_id")
def last_replayed_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER6."""
    return replay.last_replayed(_log(spark, sf_dir), ["source", "batch_id"])


@query(LOG + ", q AS (SELECT batch_id, list(event_id ORDER BY event_time, event_id) AS e FROM log GROUP BY batch_id) SELECT batch_id, array_to_string(e[1:10], ',') AS head, len(e[11:]) AS n_tail, e[11] AS next_event FROM q")
def batch_queue_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG8, PJ14, SL3, SL4."""
    head, tail = batches.head_tail(F.col("events"), 10)
    return batches.queues(_log(spark, sf_dir)).select("batch_id", F.array_join(head, ",").alias("head"), F.size(tail).cast("long").alias("n_tail"), F.get(tail, F.lit(0)).alias("next_event"))


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _log(spark, sf_dir).groupBy("source", "batch_id").agg(F.min("event_time").alias("ts_created"), F.max("binlog_seq").alias("binlog_seq"), F.max("binlog_pos").alias("binlog_pos"))
    return made.withColumns({"started": F.lit(True), "processed": F.col("batch_id") < 8, "replayed": F.col("batch_id") < 3, "binlog_name": F.concat(F.lit("bin."), F.col("binlog_seq").cast("string"))})


@query(LOG + """, b AS (SELECT source, batch_id, min(event_time) AS ts_created FROM log GROUP BY source, batch_id)
SELECT source, arg_min(batch_id, ts_created) AS batch_id FROM b WHERE batch_id < 8 AND NOT batch_id < 3 AND batch_id % 2 = 0 GROUP BY source""")
def next_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN2, SL1, FL9."""
    return batches.next_batches(_batches(spark, sf_dir), _log(spark, sf_dir).where("batch_id % 2 = 0"))


@query(LOG + """, b AS (SELECT source, batch_id, min(event_time) AS ts_created, max(binlog_seq) AS seq, max(binlog_pos) AS pos FROM log GROUP BY source, batch_id)
SELECT source, arg_max(batch_id, ts_created) AS batch_id, 'bin.' || arg_max(seq, ts_created) AS binlog_name, arg_max(pos, ts_created) AS binlog_pos FROM b WHERE NOT batch_id < 8 GROUP BY source""")
def resume_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, AG13."""
    return batches.open_coordinates(_batches(spark, sf_dir))


@query(LOG + ", s(source) AS (VALUES ('east'), ('west'), ('north')), r AS (SELECT source, max(event_time) AS t FROM log GROUP BY source), p AS (SELECT source, max(event_time) AS t FROM log WHERE batch_id < 3 GROUP BY source) SELECT s.source, date_diff('second', TIMESTAMP '1970-01-01', TIMESTAMP '2025-01-01') - r.t AS read_lag, r.t - p.t AS replay_lag FROM s LEFT JOIN r USING (source) LEFT JOIN p USING (source)")
def status_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN3, ST8."""
    log = _log(spark, sf_dir)
    clock = lambda d: d.groupBy("source").agg(F.timestamp_add("SECOND", F.max("event_time"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    named = spark.createDataFrame([("east",), ("west",), ("north",)], "source string")
    return reports.status(named, clock(log), clock(log.where("batch_id < 3")), "2025-01-01 00:00:00").select("source", "read_lag", "replay_lag")


@query("SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment FROM (SELECT event_id, user_id FROM events WHERE event_type = 'error') e LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON e.user_id = c.c_custkey")
def error_log_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN4, CT13."""
    errors = _read(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", F.col("user_id").alias("source"))
    known = _read(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("source"), "c_name", "c_mktsegment")
    return reports.errors(errors, known).select("event_id", "user_id", "c_name", "c_mktsegment")


@query(LOG + "SELECT source, count(*) AS n_events FROM log WHERE batch_id >= 3 GROUP BY source")
def replay_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG15."""
    return batches.backlog(_log(spark, sf_dir).where("batch_id >= 3"))


@query("""SELECT coalesce(s.key, c.key) AS key, coalesce(s.name, c.name) AS name, coalesce(s.balance, c.balance) AS balance FROM (SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer) c
FULL JOIN (SELECT s_suppkey * 3 AS key, s_name AS name, s_acctbal AS balance FROM supplier) s ON s.key = c.key""")
def upsert_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM4-DM6."""
    known = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return tables.upsert(known, _read(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), ["key"])


@query("SELECT c_custkey, coalesce(o.o_orderpriority, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey")
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN11, DM7."""
    new = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("c_mktsegment"))
    return tables.updated(_read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), new, ["c_custkey"], ["c_mktsegment"])


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND TIMESTAMP '1998-08-02' - o_orderdate > INTERVAL 365 DAY)")
def retention_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM8, FL10."""
    kept = _read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("replayed"), F.col("o_orderdate").alias("ts_replayed"))
    return batches.replayed_out(kept, F.lit("1998-08-02 00:00:00").cast("timestamp_ntz"), "365 days").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE TIMESTAMP '1998-08-02' - CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '1970-01-01' ELSE o_orderdate END > INTERVAL 90 DAY")
def maintenance_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL11."""
    known = _read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("last_maintenance"))
    return batches.maintenance_due(known, F.lit("1998-08-02 00:00:00").cast("timestamp_ntz"), "90 days").select("o_orderkey")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY l_orderkey")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM10."""
    parents = _read(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return batches.cascade(parents, _read(spark, sf_dir, "lineitem").select("l_orderkey"), ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query(LOG + "SELECT event_id, batch_id FROM log WHERE batch_id < 8")
def unprocessed_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DM9, ST10."""
    return batches.without_unprocessed(_log(spark, sf_dir), _batches(spark, sf_dir)).select("event_id", "batch_id")


def _copy(name: str) -> Query:
    def copy(spark: SparkSession, sf_dir: str) -> DataFrame:
        return changelog.read_table(spark, f"{sf_dir}/{name}.parquet")

    copy.__doc__ = "SC1, SK1."
    return copy


for _name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"):
    QUERIES[f"snapshot_copy_{_name}"] = _copy(_name)
    ORACLE_SQL[f"snapshot_copy_{_name}"] = f"SELECT * FROM {_name}"  # noqa: S608


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) END AS seconds FROM orders")
def zero_date_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ1, H5."""
    text = F.when(F.col("o_orderkey") % 4 == 0, "0000-00-00 00:00:00").otherwise(F.col("o_orderdate").cast("string"))
    return _read(spark, sf_dir, "orders").select("o_orderkey", _seconds(types.no_zero_date(text)).alias("seconds"))


@query("SELECT p_partkey, lower(hex(p_name)) AS hex_name, substr(lower(hex(p_name)), 9) AS spatial FROM part")
def hex_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ3, PJ4."""
    raw = F.col("p_name").cast("binary")
    return _read(spark, sf_dir, "part").select("p_partkey", types.hex_text(raw).alias("hex_name"), types.spatial_text(raw).alias("spatial"))


@query("SELECT doc_id, length(text) AS n, text AS cleaned FROM documents")
def null_byte_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK5: NUL characters put in and taken out again."""
    dirty = F.concat(F.lit("\0"), F.replace(F.col("text"), F.lit(" "), F.lit("\0 \0")), F.lit("\0"))
    return _read(spark, sf_dir, "documents").select("doc_id", F.char_length("text").cast("long").alias("n"), types.no_nul(dirty).alias("cleaned"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'NULL' ELSE '"' || replace(p_name, '"', '""') || '"' END || ',' || '"' || p_size || '"' AS line FROM part""")
def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ2."""
    name = F.when(F.col("p_partkey") % 10 != 0, F.col("p_name"))
    return _read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", types.csv_field(name), types.csv_field(F.col("p_size").cast("string"))).alias("line"))


@query("SELECT doc_id, quality <> 0 AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels")
def type_override_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG13, DG8: tinyint(1) overridden to boolean, an unsigned int widened."""
    kinds = {"quality": types.spark_type("tinyint", "tinyint(1)", table="labels", overrides={"tinyint(1)": types.Override("boolean")}), "toxic": types.spark_type("int", "int unsigned")}
    return _read(spark, sf_dir, "labels").select("doc_id", *(F.col(c).cast(k).alias(c) for c, k in kinds.items()))


@query("SELECT p_partkey, p_size, TRY_CAST(CASE WHEN p_partkey % 6 = 0 THEN 'x' || p_size ELSE p_size::VARCHAR END AS INTEGER) AS read FROM part WHERE p_partkey % 6 <> 0")
def good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK3: rows that can be converted."""
    text = F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_size", text.alias("read"))
    return tables.good_and_bad(rows, {"read": F.col("read").try_cast("int")})[0]


@query("""SELECT p_partkey, lower(hex('{"p_partkey":' || p_partkey || ',"read":"x' || p_size || '"}')) AS row_data FROM part WHERE p_partkey % 6 = 0""")
def discarded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK6, H9: rows that can't."""
    text = F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("x"), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    return tables.good_and_bad(_read(spark, sf_dir, "part").select("p_partkey", text.alias("read")), {"read": F.col("read").try_cast("int")})[1].select("p_partkey", "row_data")


@query("SELECT s_suppkey, CAST(s_acctbal AS BIGINT) AS balance, s_name, 'new' AS state, 7 AS grade FROM (SELECT s_suppkey, s_name, trunc(s_acctbal) AS s_acctbal FROM supplier)")
def alter_add_drop_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG5-DG8, DP11: several clauses in one statement; none is lost."""
    statement = ddl.parse("ALTER TABLE supplier CHANGE s_acctbal balance BIGINT NOT NULL, DROP COLUMN s_nationkey, ADD COLUMN state VARCHAR(10) DEFAULT 'new' AFTER s_name, ADD (grade INT(4) DEFAULT 7), ADD INDEX ix (grade)")[0]
    return evolve.altered(_read(spark, sf_dir, "supplier"), statement)


@query("""SELECT 'lineitem' AS child, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def fk_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT2."""
    orders = _read(spark, sf_dir, "orders")
    one = tables.orphans(_read(spark, sf_dir, "lineitem"), orders.where("o_orderstatus = 'F'"), [("l_orderkey", "o_orderkey")])
    two = tables.orphans(orders, _read(spark, sf_dir, "customer"), [("o_custkey", "c_custkey")])
    count = lambda d, name: d.agg(F.count("*").alias("n")).select(F.lit(name).alias("child"), "n")
    return count(one, "lineitem").unionByName(count(two, "orders"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT3."""
    return tables.duplicate_keys(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'o_orderkey' AS column_name, max(o_orderkey) AS last_value FROM orders UNION ALL SELECT 'o_custkey', max(o_custkey) FROM orders")
def sequence_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK14, AG17."""
    return tables.sequence_values(_read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"])


@query("SELECT l_orderkey::VARCHAR AS table_name, l_returnflag AS index_name, 0 AS non_unique, array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS columns FROM lineitem GROUP BY 1, 2 HAVING count(*) FILTER (l_discount > 0.09) = 0")
def index_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG12, SC10."""
    usage = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("table_name"), F.col("l_returnflag").alias("index_name"), F.lit(0).alias("non_unique"), F.col("l_linestatus").alias("column_name"), F.lit(1).alias("seq"), F.when(F.col("l_discount") > 0.09, 1).alias("sub_part"))
    return changelog.indices(usage).withColumn("columns", F.array_join(F.array_sort(F.array_distinct("columns")), ","))


@query("""SELECT 'fk_' || n_regionkey AS constraint_name, 'nation' AS table_name, 'region' AS referenced_table, string_agg(n_name, ',' ORDER BY n_nationkey) AS columns, string_agg(r_name || n_nationkey, ',' ORDER BY n_nationkey) AS referenced_columns FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_regionkey""")
def foreign_key_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC9, AG14, JN10."""
    both = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    usage = both.select(F.concat(F.lit("fk_"), F.col("n_regionkey").cast("string")).alias("constraint_name"), F.lit("nation").alias("table_name"), F.lit("region").alias("referenced_table"), F.col("n_name").alias("column_name"), F.concat("r_name", F.col("n_nationkey").cast("string")).alias("referenced_column"), F.col("n_nationkey").alias("position"))
    return changelog.foreign_keys(usage)


@query("SELECT n_regionkey::VARCHAR AS table_name, string_agg(n_name, ',' ORDER BY n_nationkey DESC) AS pkey FROM nation GROUP BY n_regionkey")
def existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC15: arrays of column numbers with the columns' names, in the arrays' order."""
    nation = _read(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("table_name"), F.col("n_nationkey").alias("attnum"), F.col("n_name").alias("attname"))
    constraints = nation.groupBy("table_name").agg(F.sort_array(F.collect_list("attnum"), asc=False).alias("conkey"))
    return changelog.key_columns(constraints, nation).withColumn("pkey", F.array_join("pkey", ","))


@query("SELECT event_id, 'u' || user_id || ':1-' || event_id || ',' || chr(10) || 'v' || user_id || ':5-5' AS gtids, CAST(event_id AS BIGINT) AS hi FROM events")
def gtid_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ13, A8."""
    text = F.concat(F.lit(" u"), F.col("user_id").cast("string"), F.lit(":1-"), F.col("event_id").cast("string"), F.lit(" , v"), F.col("user_id").cast("string"), F.lit(":5"))
    sets = coordinates.transaction_sets(text)
    return _read(spark, sf_dir, "events").select("event_id", coordinates.transaction_text(sets).alias("gtids"), F.get(sets, F.lit(0))["hi"].alias("hi"))


@query(LOG + "SELECT event_id, CAST(sum(CASE WHEN op = 'delete' AND event_id % 500 < 5 THEN 1 ELSE 0 END) OVER (PARTITION BY table_name ORDER BY event_id) AS BIGINT) AS epoch FROM log")
def ddl_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: a few events stand for DDL."""
    log = _log(spark, sf_dir).withColumn("op", F.when((F.col("op") == "delete") & (F.col("event_id") % 500 < 5), "ddl").otherwise(F.col("op")))
    return replay.epochs(log, ["table_name"]).select("event_id", "epoch")


@query("SELECT event_id, CAST(event_id // 750 AS BIGINT) AS batch_id FROM events")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG20, ST3."""
    return batches.numbered(_read(spark, sf_dir, "events").select("event_id"), 750)


STREAMED = ("orders", "items", "people")


def _replica(spark: SparkSession, sf_dir: str, statements: bool, **settings: object) -> tuple[Replica, str]:
    """A replica whose tables are empty and whose log holds all events, in files by time."""
    folder = work_folder(spark, "replica")
    replica = Replica(spark, Config(sources={"all": Source("all", schema_mappings={"shop": "dw"}, **settings)}), f"{folder}/store")
    replica.create_schema()
    replica.add_source("all")
    empty = spark.createDataFrame([], "user_id long, event_id long, value double")
    empty.write.parquet(f"{folder}/empty")
    replica.init_replica("all", {f"shop.{t}": f"{folder}/empty" for t in STREAMED}, {f"shop.{t}": ["user_id"] for t in STREAMED}, (0, 0))
    image = F.to_json(F.struct("user_id", "event_id", "value"))
    log = _log(spark, sf_dir).select("event_id", "batch_id", F.lit("all").alias("source"), F.lit("shop").alias("schema_name"), "table_name", "op", F.lit(None).cast("string").alias("binlog_name"), "binlog_seq", "binlog_pos", "event_time", image.alias("after"), image.alias("before"), F.lit(None).cast("string").alias("ddl"))
    if statements:
        made = [(-1, 0, "all", "shop", t, "ddl", None, 0, 0, 0, None, None, f"ALTER TABLE {t} CHANGE value amount DECIMAL(12,2), ADD COLUMN note VARCHAR(8) DEFAULT 'none'") for t in STREAMED]
        log = log.withColumn("_v", F.from_json("after", "user_id long, event_id long, value double")).withColumn("after", F.to_json(F.struct("_v.user_id", "_v.event_id", F.col("_v.value").cast("decimal(12,2)").alias("amount"), F.lit("new").alias("note")))).drop("_v")
        log = log.withColumn("before", F.lit(None).cast("string")).unionByName(spark.createDataFrame(made, changelog.SCHEMA))
    log.write.parquet(f"{folder}/log")
    return replica, folder


def _state(replica: Replica) -> DataFrame:
    found = [replica.store.read(f"dw.{t}").withColumn("table_name", F.lit(t)) for t in STREAMED]
    return found[0].unionByName(found[1]).unionByName(found[2])


BEFORE_CLASH = CUT + """, kept AS (SELECT log.* FROM log LEFT JOIN clash USING (table_name) WHERE first IS NULL OR event_id < first),
folded AS (SELECT table_name, user_id, arg_max(op, event_id) FILTER (op <> 'update') AS last_op, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM kept GROUP BY table_name, user_id)
"""


@query(BEFORE_CLASH + "SELECT table_name, user_id, event_id, value FROM folded WHERE last_op = 'insert'")
def stream_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1-ST10, ER1-ER3, SC1, SK4, SK9: snapshot, then the log as a stream into the store; a table stops at its first conflict."""
    replica, folder = _replica(spark, sf_dir, False)
    start_replica(replica, "all", f"{folder}/log", f"{folder}/checkpoint", once=True).awaitTermination()
    return _state(replica)


@query(BEFORE_CLASH + "SELECT table_name, user_id, event_id, CAST(value AS DECIMAL(12, 2)) AS amount, 'new' AS note FROM folded WHERE last_op = 'insert'")
def ddl_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG5-DG8, H8, SK7: the same with statements in the log that change the tables first."""
    replica, folder = _replica(spark, sf_dir, True)
    replica.replay_batch("all", changelog.read_log(spark, f"{folder}/log"), 0)
    return _state(replica)


@query(CUT + """SELECT table_name, c.first AS event_id, 'disabled' AS state FROM clash c""")
def disabled_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER2, ER3, CT10: tables that the replay disabled, and the event that did it."""
    replica, folder = _replica(spark, sf_dir, False)
    replica.replay_batch("all", changelog.read_log(spark, f"{folder}/log"), 0)
    off = replica.catalog("replica_tables").where("not enabled").select("table_name")
    return replica.show_errors().join(off, "table_name").select("table_name", "event_id", F.lit("disabled").alias("state"))


#: Statements of every production and the kind, table and detail that the parser must give.
STATEMENTS = [
    ("CREATE TABLE `ship log` (no BIGINT(12) UNSIGNED NOT NULL AUTO_INCREMENT, entry VARCHAR(80), PRIMARY KEY (no), KEY words (entry(20)))", "CreateTable", "ship log", "no"),
    ("create table IF NOT EXISTS fleet.crew (ship int, rank enum('mate','cook') default 'cook', unique key (ship,rank)) engine=memory", "CreateTable", "crew", "ship,rank"),
    ("ALTER TABLE cargo ADD `weight` DECIMAL(9,2) NULL, ADD COLUMN port VARCHAR(30) default 'home' AFTER `weight`, DROP FOREIGN KEY owner", "AlterTable", "cargo", "add weight,add port"),
    ("ALTER TABLE cargo ADD (crates INT UNSIGNED DEFAULT 1, barrels TINYINT DEFAULT NULL)", "AlterTable", "cargo", "add crates,add barrels"),
    ("ALTER TABLE `fleet`.`mast` CHANGE COLUMN `HEIGHT` `metres` DOUBLE NULL DEFAULT NULL COMMENT 'above deck, not keel'", "AlterTable", "mast", "change HEIGHT"),
    ("ALTER TABLE mast MODIFY sails BIGINT DEFAULT 3", "AlterTable", "mast", "modify sails"),
    ("ALTER TABLE sloop RENAME TO cutter", "RenameTable", "sloop", "cutter"),
    ("RENAME TABLE `fleet`.`brig` TO `fleet`.`hulk`", "RenameTable", "brig", "hulk"),
    ("DROP TABLE IF EXISTS `wreck`", "DropTable", "wreck", ""),
    ("TRUNCATE TABLE fleet.manifest", "Truncate", "manifest", ""),
    ("ALTER TABLE berth DROP PRIMARY KEY", "DropPrimaryKey", "berth", ""),
    ("CREATE UNIQUE INDEX by_name ON ship (name, port)", "AlterTable", "ship", "add_index by_name"),
    ("DROP INDEX by_name ON ship", "AlterTable", "ship", "drop_index by_name"),
    ("CREATE TEMPORARY TABLE tide (height int)", "Unknown", "", ""),
]


@query("SELECT * FROM (VALUES " + ", ".join("({}, '{}', '{}', '{}')".format(i, k, t, d) for i, (_, k, t, d) in enumerate(STATEMENTS)) + ") v(id, kind, table_name, detail)")
def ddl_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DP1-DP16."""
    rows = []
    for i, (text, *_) in enumerate(STATEMENTS):
        s = ddl.parse(text)[0]
        detail = ",".join(s.primary_key) if isinstance(s, ddl.CreateTable) else ",".join(f"{c.action} {c.name}" for c in s.changes) if isinstance(s, ddl.AlterTable) else getattr(s, "to", "")
        rows.append((i, type(s).__name__, getattr(s, "name", ""), detail))
    return spark.createDataFrame(rows, "id int, kind string, table_name string, detail string")


@query(CUT + """, kept AS (SELECT * FROM log WHERE event_id < (SELECT coalesce(min(first), 1e18) FROM clash)),
folded AS (SELECT table_name, user_id, arg_max(op, event_id) FILTER (op <> 'update') AS last_op, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM kept GROUP BY table_name, user_id)
SELECT table_name, user_id, event_id, value FROM folded WHERE last_op = 'insert'""")
def replay_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ER4, ST4: the replica's tables after a replay that ends at the first conflict of any, and is tried again."""
    replica, folder = _replica(spark, sf_dir, False, on_error_replay="exit")
    for _ in range(2):
        try:
            replica.replay_batch("all", changelog.read_log(spark, f"{folder}/log"), 0)
        except RuntimeError:
            pass
    return _state(replica)


@query(LOG + """SELECT event_id, table_name, lower(hex('{"user_id":"x' || user_id || '"}')) AS row_data FROM log WHERE event_id % 97 = 0 AND op <> 'delete'""")
def replay_discarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK3, SK6: images that a replay can't read."""
    replica, folder = _replica(spark, sf_dir, False)
    log = changelog.read_log(spark, f"{folder}/log")
    broken = F.concat(F.lit('{"user_id":"x'), F.get_json_object("after", "$.user_id"), F.lit('"}'))
    replica.replay_batch("all", log.withColumn("after", F.when((F.col("event_id") % 97 == 0) & (F.col("op") != "delete"), broken).otherwise(F.col("after"))), 0)
    return replica.catalog("discarded_rows").select("event_id", "table_name", "row_data")


def _typed_snapshot(spark: SparkSession, sf_dir: str) -> Replica:
    """orders as an origin gives it: texts, zero dates, a flag, prices that are no numbers."""
    folder = work_folder(spark, "typed")
    price = F.when(F.col("o_orderkey") % 11 == 0, F.lit("much")).otherwise(F.col("o_orderkey").cast("string"))
    day = F.when(F.col("o_orderkey") % 4 == 0, "0000-00-00 00:00:00").otherwise(F.col("o_orderdate").cast("string"))
    flag = (F.col("o_orderkey") % 2).cast("string")
    _read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), price.alias("price"), day.alias("day"), flag.alias("flag")).write.parquet(f"{folder}/origin")
    replica = Replica(spark, Config(sources={"all": Source("all", schema_mappings={"shop": "dw"})}, type_override={"tinyint(1)": types.Override("boolean")}), f"{folder}/store")
    replica.create_schema()
    replica.add_source("all")
    kinds = {"o_orderkey": ("bigint", "bigint(20)"), "price": ("decimal", "decimal(14,2)"), "day": ("datetime", "datetime"), "flag": ("tinyint", "tinyint(1)")}
    replica.init_replica("all", {"shop.orders": f"{folder}/origin"}, {"shop.orders": ["o_orderkey"]}, (0, 0), types={"shop.orders": kinds})
    return replica


@query("SELECT o_orderkey, CAST(o_orderkey AS DECIMAL(14, 2)) AS price, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE date_diff('second', TIMESTAMP '1970-01-01', o_orderdate) END AS seconds, o_orderkey % 2 = 1 AS flag FROM orders WHERE o_orderkey % 11 <> 0")
def snapshot_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PJ1, DG13, SK1: a snapshot converted from the origin's texts, with an override."""
    return _typed_snapshot(spark, sf_dir).store.read("dw.orders").select("o_orderkey", "price", types.epoch_seconds(F.col("day")).alias("seconds"), "flag")


@query("SELECT 'shop' AS schema_name, 'orders' AS table_name, count(*) AS n FROM orders WHERE o_orderkey % 11 = 0")
def snapshot_discarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK3, SK6: what such a snapshot discards."""
    return _typed_snapshot(spark, sf_dir).catalog("discarded_rows").groupBy("schema_name", "table_name").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0")
def tables_renamed_and_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG1, DG2, DG10: a log that creates, renames, truncates and drops tables between rows."""
    folder = work_folder(spark, "moved")
    replica = Replica(spark, Config(sources={"all": Source("all", schema_mappings={"shop": "dw"})}), f"{folder}/store")
    replica.create_schema()
    replica.add_source("all")
    rows = _read(spark, sf_dir, "customer")
    top = rows.agg(F.max("c_custkey")).first()[0]
    said = [(0, "CREATE TABLE first (c_custkey BIGINT PRIMARY KEY, c_name VARCHAR(40)); CREATE TABLE gone (k INT PRIMARY KEY)"), (top + 2, "TRUNCATE TABLE first; DROP TABLE gone; RENAME TABLE first TO second")]
    events = rows.select((F.col("c_custkey") + 1).alias("event_id"), F.lit("first").alias("table_name"), F.to_json(F.struct("c_custkey", "c_name")).alias("after")).unionByName(
        rows.where("c_custkey % 3 = 0").select((F.col("c_custkey") + top + 3).alias("event_id"), F.lit("second").alias("table_name"), F.to_json(F.struct("c_custkey", "c_name")).alias("after")))
    none = F.lit(None).cast("string")
    log = events.select("event_id", F.lit(0).cast("long").alias("batch_id"), F.lit("all").alias("source"), F.lit("shop").alias("schema_name"), "table_name", F.lit("insert").alias("op"), none.alias("binlog_name"), F.lit(0).alias("binlog_seq"), F.col("event_id").alias("binlog_pos"), F.lit(0).cast("long").alias("event_time"), "after", none.alias("before"), none.alias("ddl"))
    ddl_rows = spark.createDataFrame([(i, 0, "all", "shop", None, "ddl", None, 0, i, 0, None, None, text) for i, text in said], changelog.SCHEMA)
    replica.replay_batch("all", log.unionByName(ddl_rows), 0)
    return replica.store.read("dw.second")


@query(LOG + """SELECT event_id, string_agg(key || '=' || value, ',' ORDER BY key) AS pairs FROM (SELECT DISTINCT event_id, k.key AS key, k.value ->> '$' AS value FROM events, json_each(props) k) GROUP BY event_id""")
def regrouped_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG7: images taken apart and put together again, an event a row."""
    found = changelog.pairs(_read(spark, sf_dir, "events").select("event_id", "props"), "props")
    return found.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "key", "value"))), ",").alias("pairs"))


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def statements_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL5: clicks stand for BEGIN, views for COMMIT."""
    said = F.when(F.col("event_type") == "click", " begin ").when(F.col("event_type") == "view", "COMMIT").otherwise(F.concat(F.lit("UPDATE "), "event_type"))
    return _read(spark, sf_dir, "events").where(routing.statements_kept(said)).select("event_id", "event_type")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def active_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL13: segments stand for states, two of them of rest."""
    status = F.when(F.col("c_mktsegment") == "BUILDING", "ready").when(F.col("c_mktsegment") == "MACHINERY", "stopped").otherwise("running")
    return tables.active(_read(spark, sf_dir, "customer").withColumn("status", status)).select("c_custkey", "c_name")


@query("SELECT n_name AS source, r_name AS origin, 'dw_' || lower(r_name) AS destination FROM nation JOIN region ON n_regionkey = r_regionkey")
def exploded_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN6, A2: each source's mapping of schemas, a row each."""
    both = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return tables.mappings(both.select(F.col("n_name").alias("source"), F.create_map(F.col("r_name"), F.concat(F.lit("dw_"), F.lower("r_name"))).alias("schema_mappings")))


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey OFFSET 100 LIMIT 250")
def copy_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SL6, SC2: a slice of an ordered copy, its length from the memory that it may take."""
    size = types.slice_rows("250k", 1024)
    return _read(spark, sf_dir, "orders").orderBy("o_orderkey").offset(100).limit(size).select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer")
def correlated_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN14: a count for each row of another table, 0 where there is none."""
    counts = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return _read(spark, sf_dir, "customer").select("c_custkey").join(counts, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("SELECT n_name AS index_name, r_name AS table_name, CASE WHEN n_nationkey % 2 = 0 THEN 'uq_' || n_name END AS constraint_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def indexes_of_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN9."""
    both = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("index_name"), F.col("r_name").alias("table_name"), "n_nationkey")
    return changelog.index_constraints(both.drop("n_nationkey"), both.where("n_nationkey % 2 = 0").withColumn("constraint_name", F.concat(F.lit("uq_"), "index_name"))).select("index_name", "table_name", "constraint_name")


@query("SELECT n_name AS source, CASE n_nationkey % 3 WHEN 0 THEN 'log_bin' WHEN 1 THEN 'binlog_format' ELSE 'binlog_row_image' END AS name, CASE n_nationkey % 2 WHEN 0 THEN 'full' ELSE 'row' END AS value, CASE n_nationkey % 3 WHEN 0 THEN 'ON' WHEN 1 THEN 'ROW' ELSE 'FULL' END AS wanted FROM nation WHERE NOT ((n_nationkey % 3 = 1 AND n_nationkey % 2 = 1) OR (n_nationkey % 3 = 2 AND n_nationkey % 2 = 0))")
def feed_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL16: settings of feeds that rows can't be replayed from."""
    name = F.when(F.col("n_nationkey") % 3 == 0, "log_bin").when(F.col("n_nationkey") % 3 == 1, "binlog_format").otherwise("binlog_row_image")
    return changelog.feed_problems(_read(spark, sf_dir, "nation").select(F.col("n_name").alias("source"), name.alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "full").otherwise("row").alias("value")))


@query("SELECT r_name AS schema_name, 'nation' AS table_name, string_agg(n_name || ':' || 'int', ',' ORDER BY n_name) AS types FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC8, SC11, SC12: a map of types for each table; nations stand for columns."""
    both = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    kind = dict((c, t) for _, _, c, t in changelog.table_columns(both, "s", "t"))["n_nationkey"]
    maps = changelog.type_map(both.select(F.col("r_name").alias("schema_name"), F.lit("nation").alias("table_name"), F.col("n_name").alias("column_name"), F.lit(kind).alias("type")))
    return maps.withColumn("types", F.array_join(F.transform(F.array_sort(F.map_entries("types")), lambda e: F.concat_ws(":", e["key"], e["value"])), ","))


@query(LOG + ", marked AS (SELECT source, max(event_time) AS received, max(event_time) FILTER (batch_id < 3) AS replayed FROM log GROUP BY source) SELECT source, received > replayed AS waits FROM marked")
def pause_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN5, ST9: whether a source that is to pause has still to replay what it received."""
    log = _log(spark, sf_dir)
    received, replayed = (d.groupBy("source").agg(F.max("event_time").alias(n)) for d, n in ((log, "received"), (log.where("batch_id < 3"), "replayed")))
    return batches.pause_gate(log.select("source").distinct(), received, replayed)


@query(LOG + "SELECT event_id, table_name FROM log WHERE table_name IN ('orders', 'people')")
def logs_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL8: events of the tables that their source's array names."""
    listed = spark.createDataFrame([("east", ["orders", "people"]), ("west", ["people", "orders"])], "source string, log_tables array<string>")
    return routing.listed(_log(spark, sf_dir), listed).select("event_id", "table_name")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR (c_custkey > 50 AND c_mktsegment = 'AUTOMOBILE')")
def enum_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG9: a log whose statements list an enum's values, then more of them; rows with others are discarded."""
    folder = work_folder(spark, "enums")
    replica = Replica(spark, Config(sources={"all": Source("all", schema_mappings={"shop": "dw"})}), f"{folder}/store")
    replica.create_schema()
    replica.add_source("all")
    none = F.lit(None).cast("string")
    rows = _read(spark, sf_dir, "customer").select((2 * F.col("c_custkey") + 1).alias("event_id"), F.to_json(F.struct("c_custkey", "c_mktsegment")).alias("after"))
    log = rows.select("event_id", F.lit(0).cast("long").alias("batch_id"), F.lit("all").alias("source"), F.lit("shop").alias("schema_name"), F.lit("kinds").alias("table_name"), F.lit("insert").alias("op"), none.alias("binlog_name"), F.lit(0).alias("binlog_seq"), F.col("event_id").alias("binlog_pos"), F.lit(0).cast("long").alias("event_time"), "after", none.alias("before"), none.alias("ddl"))
    said = [(0, "CREATE TABLE kinds (c_custkey BIGINT PRIMARY KEY, c_mktsegment ENUM('BUILDING','MACHINERY'))"), (102, "ALTER TABLE kinds MODIFY c_mktsegment ENUM('BUILDING','MACHINERY','AUTOMOBILE')")]
    ddl_rows = spark.createDataFrame([(i, 0, "all", "shop", None, "ddl", None, 0, i, 0, None, None, text) for i, text in said], changelog.SCHEMA)
    replica.replay_batch("all", log.unionByName(ddl_rows), 0)
    return replica.store.read("dw.kinds")


#: orders as a PostgreSQL origin describes some of its columns.
DESCRIBED = "column_name string, ordinal_position int, data_type string, numeric_precision int, numeric_scale int, is_nullable string, column_default string"
ORDERS = [
    ("o_totalprice", 3, "numeric", 14, 2, "YES", None), ("o_orderkey", 1, "bigint", 64, 0, "NO", "nextval('orders_key'::regclass)"),
    ("o_orderdate", 2, "date", None, None, "YES", "CURRENT_DATE"), ("o_orderpriority", 4, "character varying", None, None, "YES", None),
]


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(14, 2)) AS o_totalprice, o_orderpriority FROM orders")
def table_of_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DG3: rows in the columns that an origin's metadata describes."""
    kind = evolve.described(r.asDict() for r in spark.createDataFrame(ORDERS, DESCRIBED).collect())
    return _read(spark, sf_dir, "orders").select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields))


@query("SELECT 'o_orderkey' AS column_name, max(o_orderkey) AS last_value FROM orders")
def serial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FL15, SK14: the greatest values of the columns that a sequence fills."""
    found = tables.serials(spark.createDataFrame(ORDERS, DESCRIBED))
    return tables.sequence_values(_read(spark, sf_dir, "orders"), [r.column_name for r in found.collect()])


@query("""SELECT 'dw.orders' AS child, 'dw.buyers' AS parent, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'dw.buyers', 'dw.nation', 0""")
def foreign_keys_of_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CT2, CT12: rows without a parent in a replica's tables, by key."""
    folder = work_folder(spark, "children")
    replica = Replica(spark, Config(sources={"all": Source("all", schema_mappings={"shop": "dw"})}), f"{folder}/store")
    replica.create_schema()
    replica.add_source("all")
    _read(spark, sf_dir, "customer").where("c_acctbal >= 0").write.parquet(f"{folder}/buyers")
    replica.init_replica("all", {"shop.orders": f"{sf_dir}/orders.parquet", "shop.buyers": f"{folder}/buyers", "shop.nation": f"{sf_dir}/nation.parquet"}, {"shop.orders": ["o_orderkey"], "shop.buyers": ["c_custkey"], "shop.nation": ["n_nationkey"]}, (0, 0))
    return replica.validate_foreign_keys([("dw.orders", "dw.buyers", [("o_custkey", "c_custkey")]), ("dw.buyers", "dw.nation", [("c_nationkey", "n_nationkey")])])
