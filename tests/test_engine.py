"""A replica from snapshot to stream, in one temporary folder."""

from __future__ import annotations

import json

import pytest

from tideline.operators import replay
from tideline.plans.engine import Replica
from tideline.plans.store import Store
from tideline.sources.changelog import SCHEMA
from tideline.sources.config import Config, TableRules
from tideline.streaming.replication import run_replica, start_replica, stop_all_replicas

RAW = {
    "type_override": {"tinyint(1)": {"override_to": "boolean", "override_tables": ["*"]}},
    "fillfactor": {"30": {"tables": ["shop.t"]}},
    "sources": {"one": {"db_conn": {"host": "x", "schema_mappings": {"ignored": "x"}}, "schema_mappings": {"shop": "dw"}, "skip_tables": ["shop.hidden"], "skip_events": {"delete": ["shop.keep"], "update": None}, "type": "mysql"}},
}


def event(i, op, table, after=None, before=None, ddl=None, pos=None):
    return (i, 0, "one", "shop", table, op, "bin.000001", 1, i * 10 if pos is None else pos, 1_700_000_000 + i, after and json.dumps(after), before and json.dumps(before), ddl)


@pytest.fixture
def replica(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(str(tmp_path / "t"))
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(str(tmp_path / "keep"))
    r = Replica(spark, Config.of(RAW), str(tmp_path / "store"))
    r.create_schema()
    r.add_source("one")
    r.init_replica("one", {"shop.t": str(tmp_path / "t"), "shop.keep": str(tmp_path / "keep"), "shop.hidden": str(tmp_path / "keep")}, {"shop.t": ["id"], "shop.keep": ["id"]}, (1, 15))
    return r


def state(r, table):
    return sorted(tuple(x) for x in r.store.read(table).collect())


def test_snapshot(replica):
    assert state(replica, "dw.t") == [(1, "a"), (2, "b")]
    assert not replica.store.exists("dw.hidden")
    assert replica.store.info("dw.t")["fillfactor"] == 30
    assert [(x.status, x.n) for x in replica.show_tables().collect()] == [("not replicated", 0), ("replicated", 2), ("all", 2)]


def test_batch(spark, replica):
    log = spark.createDataFrame([
        event(1, "insert", "t", {"id": 9, "v": "before the snapshot"}), event(2, "insert", "t", {"id": 3, "v": "c"}), event(3, "update", "t", {"id": 1, "v": "A"}, {"id": 1, "v": "a"}),
        event(4, "delete", "t", {"id": 2, "v": "b"}), event(5, "delete", "keep", {"id": 1, "v": "a"}), event(6, "ddl", "t", ddl="ALTER TABLE t ADD n INT DEFAULT 7"),
        event(7, "update", "t", {"id": 4, "v": "moved", "n": 8}, {"id": 3, "v": "c"}), event(8, "ddl", "u", ddl="CREATE TABLE u (k INT PRIMARY KEY, w VARCHAR(3)); CREATE TABLE keyless (a INT)"), event(9, "insert", "u", {"k": 1, "w": "x"}),
    ], SCHEMA)
    done = replica.replay_batch("one", log, 0)
    assert state(replica, "dw.t") == [(1, "A", 7), (4, "moved", 8)]
    assert state(replica, "dw.keep") == [(1, "a")]
    assert state(replica, "dw.u") == [(1, "x")] and not replica.store.exists("dw.keyless")
    assert done["ddl"] == 2 and done["replayed"] == 5
    assert replica.replay_batch("one", log, 0) == {"replayed": 0, "skipped": 0, "ddl": 0}
    assert replica.catalog("sources").first().consistent
    assert replica.run_maintenance("one") > 0
    assert replica.detach_replica("one")["dw.t"] == 4


def test_conflict_disables_the_table(spark, replica):
    log = spark.createDataFrame([event(2, "insert", "t", {"id": 5, "v": "x"}), event(3, "insert", "t", {"id": 1, "v": "clash"}), event(4, "insert", "t", {"id": 6, "v": "late"})], SCHEMA)
    replica.replay_batch("one", log, 0)
    assert state(replica, "dw.t") == [(1, "a"), (2, "b"), (5, "x")]
    assert [(e.table_name, e.event_id, e.pkey) for e in replica.show_errors().collect()] == [("t", 3, "\"id\"='1'")]
    assert [t.table_name for t in replica.catalog("replica_tables").where("not enabled").collect()] == ["t"]


def test_key_changes_of_missing_rows_do_nothing(spark, replica):
    log = spark.createDataFrame([
        event(2, "update", "t", {"id": 7, "v": "phantom"}, {"id": 6, "v": "x"}), event(3, "update", "t", {"id": 1, "v": "no clash"}, {"id": 6, "v": "x"}),
        event(4, "update", "t", {"id": 8, "v": "phantom"}, {"id": 7, "v": "x"}), event(5, "update", "t", {"id": 3, "v": "moved"}, {"id": 2, "v": "b"}),
    ], SCHEMA)
    assert replica.replay_batch("one", log, 0)["replayed"] == 4
    assert state(replica, "dw.t") == [(1, "a"), (3, "moved")] and replica.show_errors().count() == 0
    replica.replay_batch("one", spark.createDataFrame([event(6, "update", "t", {"id": 1, "v": "clash"}, {"id": 3, "v": "moved"})], SCHEMA), 1)
    assert state(replica, "dw.t") == [(1, "a"), (3, "moved")]
    assert [e.event_id for e in replica.show_errors().collect()] == [6]


def mixed_batch(spark):
    return spark.createDataFrame([
        event(2, "insert", "t", {"id": 3, "v": "c"}), event(3, "update", "t", {"id": 1, "v": "A"}, {"id": 1, "v": "a"}), event(4, "update", "keep", {"id": 1, "v": "B"}, {"id": 1, "v": "a"}),
        event(5, "ddl", "t", ddl="ALTER TABLE t ADD n INT DEFAULT 7"), event(6, "insert", "t", {"id": 4, "v": "d", "n": 1}), event(7, "ddl", "u", ddl="CREATE TABLE u (k INT PRIMARY KEY)"),
        event(8, "insert", "u", {"k": 1}), event(9, "insert", "keep", {"id": 1, "v": "clash"}), event(10, "insert", "keep", {"id": 2, "v": "late"}),
    ], SCHEMA)


def test_a_batch_that_failed_anywhere_goes_on(spark, replica, monkeypatch):
    given, log = Store.publish, mixed_batch(spark)
    count = [0, 0]

    def failing(store, staged):
        count[0] += 1
        if count[0] == count[1]:
            raise OSError("lost")
        given(store, staged)

    monkeypatch.setattr(Store, "publish", failing)
    for last in range(1, 30):  # each try fails one publication later
        count[:] = [0, last]
        try:
            done = replica.replay_batch("one", log, 0)
            break
        except OSError:
            pass
    assert last > 5 and done == {"replayed": 5, "skipped": 2, "ddl": done["ddl"]}
    assert state(replica, "dw.t") == [(1, "A", 7), (2, "b", 7), (3, "c", 7), (4, "d", 1)] and state(replica, "dw.u") == [(1,)] and state(replica, "dw.keep") == [(1, "B")]
    assert [(e.table_name, e.event_id) for e in replica.show_errors().collect()] == [("keep", 9)]
    assert [t.table_name for t in replica.catalog("replica_tables").where("not enabled").collect()] == ["keep"]


def test_a_batch_writes_what_it_changes(spark, replica, tmp_path):
    spark.range(20_000).selectExpr("id", "repeat(md5(string(id)), 4) as v").repartition(4).write.parquet(str(tmp_path / "large"))
    replica.sync_tables("one", "shop.t", {"shop.t": str(tmp_path / "large")}, {"shop.t": ["id"]}, (1, 15))
    folder = tmp_path / "store" / "dw" / "t"
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    whole = size()
    model = {(i,): None for i in range(20_000)}
    for batch in range(6):
        first = 100 * batch + 2
        rows = [("update", first), ("delete", first + 1), ("insert", 30_000 + batch), ("update", 30_000 + batch - 1), ("delete", 40_000)]
        log = [event(10 * batch + k + 2, op, "t", {"id": i, "v": f"{op} {batch}"}, None if op == "insert" else {"id": i, "v": "x"}) for k, (op, i) in enumerate(rows)]
        log.append(event(10 * batch + 8, "update", "t", {"id": 50_000 + batch, "v": f"moved {batch}"}, {"id": first, "v": "x"}))
        replica.replay_batch("one", spark.createDataFrame(log, SCHEMA), batch)
        model, clash = replay.sequential([*((op, (i,), None, f"{op} {batch}") for op, i in rows), ("update", (50_000 + batch,), (first,), f"moved {batch}")], model)
        assert clash is None
    assert size() < whole * 1.2
    levels = replica.store._pointer("dw.t")["levels"]
    assert 1 <= len(levels) <= 4 and all(a["rows"] >= 2 * b["rows"] for a, b in zip(levels, levels[1:]))
    wanted = {k[0]: v for k, v in model.items()}

    def holds():
        found = replica.store.read("dw.t").collect()
        assert len(found) == len(wanted) and {r.id: None if wanted[r.id] is None else r.v for r in found} == wanted

    holds()
    replica.run_maintenance("one")
    assert not replica.store._pointer("dw.t").get("levels") and len([d for d in folder.iterdir() if d.is_dir()]) == 1
    holds()
    replica.replay_batch("one", spark.createDataFrame([event(90, "insert", "t", {"id": 7, "v": "clash"}), event(91, "delete", "t", None, {"id": 8, "v": "x"})], SCHEMA), 6)
    assert [e.event_id for e in replica.show_errors().collect()] == [90]
    holds()


def test_exit_keeps_what_comes_before(spark, replica, tmp_path):
    replica.config = Config.of(RAW | {"sources": {"one": RAW["sources"]["one"] | {"on_error_replay": "exit"}}})
    log = mixed_batch(spark).unionByName(spark.createDataFrame([event(11, "insert", "t", {"id": 1, "v": "x", "n": 0}), event(12, "insert", "u", {"k": 2})], SCHEMA))
    for _ in range(2):
        with pytest.raises(RuntimeError, match="event 9"):
            replica.replay_batch("one", log, 0)
        assert state(replica, "dw.t") == [(1, "A", 7), (2, "b", 7), (3, "c", 7), (4, "d", 1)] and state(replica, "dw.u") == [(1,)] and state(replica, "dw.keep") == [(1, "B")]
        assert [(e.table_name, e.event_id, e.status) for e in replica.show_errors().collect()] == [("keep", 9, "error")]
    spark.createDataFrame([(1, "clash"), (2, "late")], "id long, v string").write.parquet(str(tmp_path / "again"))
    replica.sync_tables("one", "shop.keep", {"shop.keep": str(tmp_path / "again")}, {"shop.keep": ["id"]}, (1, 105))
    with pytest.raises(RuntimeError, match="event 11"):
        replica.replay_batch("one", log, 0)


def test_bad_images_are_discarded(spark, replica):
    rows = [event(2, "insert", "t", {"id": "notanumber", "v": "x"}), event(3, "insert", "t"), event(4, "insert", "t", {"id": 7, "v": "ok"}), event(5, "update", "t", {"id": 1, "v": "y"}, {"id": "q"}), event(6, "delete", "t", None, {"id": 2, "v": "b"})]
    broken = (*event(8, "insert", "t")[:10], "{broken", None, None)
    done = replica.replay_batch("one", spark.createDataFrame([*rows, broken], SCHEMA), 0)
    assert done["replayed"] == 2 and done["skipped"] == 4 and state(replica, "dw.t") == [(1, "a"), (7, "ok")]
    assert {r.event_id: bytes.fromhex(r.row_data).decode() for r in replica.catalog("discarded_rows").collect()} == {2: '{"id": "notanumber", "v": "x"}', 3: "", 5: '{"id": 1, "v": "y"}', 8: "{broken"}


def test_stream_derives_the_file_number(spark, replica, tmp_path):
    path = str(tmp_path / "log")
    rows = [event(2, "insert", "t", {"id": 3, "v": "c"}), event(1, "insert", "t", {"id": 8, "v": "before the snapshot"})]
    spark.createDataFrame([(*r[:7], None, *r[8:]) for r in rows], SCHEMA).write.parquet(path)
    replica.pause("one")
    replica.config = Config.of(RAW | {"sources": {"one": RAW["sources"]["one"] | {"sleep_loop": 0.1}}})
    import threading

    threading.Timer(2, lambda: replica.resume("one")).start()
    assert run_replica(replica, "one", path, str(tmp_path / "checkpoint"), rounds=1) == 1
    assert state(replica, "dw.t") == [(1, "a"), (2, "b"), (3, "c")]
    stop_all_replicas(replica)
    assert replica._source("one")["status"] == "stopped"


def test_stream(spark, replica, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([event(2, "insert", "t", {"id": 3, "v": "c"})], SCHEMA).write.parquet(path)
    start_replica(replica, "one", path, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    spark.createDataFrame([event(3, "delete", "t", {"id": 1, "v": "a"})], SCHEMA).write.mode("append").parquet(path)
    start_replica(replica, "one", path, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert state(replica, "dw.t") == [(2, "b"), (3, "c")]
    assert replica.show_status().count() == 1


def test_enum_values_are_enforced(spark, replica):
    log = spark.createDataFrame([
        event(2, "ddl", "e", ddl="CREATE TABLE e (k INT PRIMARY KEY, c ENUM('x','y'))"), event(3, "insert", "e", {"k": 1, "c": "x"}), event(4, "insert", "e", {"k": 2, "c": "z"}), event(5, "insert", "e", {"k": 3, "c": None}),
        event(6, "ddl", "e", ddl="ALTER TABLE e MODIFY c ENUM('y','z'), ADD d ENUM('p') DEFAULT 'p'"), event(7, "update", "e", {"k": 3, "c": "z", "d": "p"}, {"k": 3, "c": None, "d": "p"}),
        event(8, "insert", "e", {"k": 4, "c": "y", "d": "q"}), event(9, "delete", "e", None, {"k": 1, "c": "x", "d": "p"}),
    ], SCHEMA)
    replica.replay_batch("one", log, 0)
    assert state(replica, "dw.e") == [(3, "z", "p")]
    assert sorted(r.event_id for r in replica.catalog("discarded_rows").collect()) == [4, 8]


def test_maintenance_when_due(spark, replica):
    assert not replica.maintain_if_due("one", 10**9)
    replica.config = Config.of(RAW | {"sources": {"one": RAW["sources"]["one"] | {"auto_maintenance": "1 hour"}}})
    replica.replay_batch("one", spark.createDataFrame([event(2, "insert", "t", {"id": 5, "v": "x"})], SCHEMA), 0)
    assert [replica.maintain_if_due("one", 10**9 + s) for s in (0, 3000, 3601)] == [True, False, True]
    assert replica.version() == 1 and state(replica, "dw.t") == [(1, "a"), (2, "b"), (5, "x")]


def test_rules():
    source = Config.of(RAW).sources["one"]
    rules = TableRules.of(source, "shop.t,shop.hidden")
    assert rules.keeps("shop", "t") and not rules.keeps("shop", "hidden") and not rules.keeps("shop", "keep") and rules.keeps("other", "x")
    with pytest.raises(ValueError):
        Config.of({"sources": {"x": {"type": "odd"}}})


def test_destination_mapped_twice(replica):
    replica.config = Config.of({"sources": {"two": {"schema_mappings": {"a": "dw"}}}})
    with pytest.raises(ValueError):
        replica.add_source("two")
