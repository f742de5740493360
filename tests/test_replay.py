"""The fold against a sequential replay, on random logs."""

from __future__ import annotations

import random

import pytest

from tideline.operators import replay


@pytest.mark.parametrize("seed", range(4))
def test_fold_is_sequential_replay(spark, seed):
    rng = random.Random(seed)
    events = [(i, rng.choice(["insert", "update", "update", "delete"]), rng.randrange(8), i * 10) for i in range(60)]
    base = {k: -k for k in range(0, 8, 3)}
    log = spark.createDataFrame(events, "event_id long, op string, k long, v long")
    start = spark.createDataFrame(list(base.items()), "k long, v long")
    got = {r.k: r.v for r in replay.fold(log, ["k"], ["v"], start).collect()}
    want, _ = replay.sequential([(op, (k,), None, (v,)) for _, op, k, v in events], {(k,): (v,) for k, v in base.items()}, strict=False)
    assert got == {k[0]: v[0] for k, v in want.items()}
    _, first = replay.sequential([(op, (k,), None, (v,)) for _, op, k, v in events], {(k,): (v,) for k, v in base.items()})
    clash = [r.event_id for r in replay.conflicts(log, ["k"], start).collect()]
    assert (min(clash) if clash else None) == first


def test_null_keys_match_nothing(spark):
    log = spark.createDataFrame([(1, "insert", None, 5), (2, "insert", 1, 6)], "event_id long, op string, k long, v long")
    assert [tuple(r) for r in replay.fold(log, ["k"], ["v"]).collect()] == [(1, 6)]


def test_key_change_moves_the_row(spark):
    log = spark.createDataFrame([(1, "insert", 1, 1, 5), (2, "update", 2, 1, 6)], "event_id long, op string, k long, b long, v long")
    moved = replay.split_key_changes(log, ["k"], ["b"])
    assert [tuple(r) for r in replay.fold(moved, ["k"], ["v"]).collect()] == [(2, 6)]


@pytest.mark.parametrize("seed", range(6))
def test_key_changes_are_sequential_replay(spark, seed):
    rng = random.Random(seed)
    size = (5, 12, 40)[seed % 3]
    kinds = ["insert", "delete", "update", "move", "move", "move"]
    events = []
    for i in range(80):
        op, k, b = rng.choice(kinds), rng.randrange(size), rng.randrange(size)
        events.append((i, "update" if op == "move" else op, k, k % 2, b if op == "move" else k, (b if op == "move" else k) % 2, i * 10))
    base = {k: -k for k in range(0, size, 3)}
    log = spark.createDataFrame(events, "event_id long, op string, k long, j long, bk long, bj long, v long")
    start = spark.createDataFrame([(k, k % 2, v) for k, v in base.items()], "k long, j long, v long")
    key, old = ["k", "j"], ["bk", "bj"]
    steps = replay.split_key_changes(replay.settle_key_changes(log, key, old, start), key, old).cache()
    got = {(r.k, r.j): r.v for r in replay.fold(steps, key, ["v"], start).collect()}
    model = [(op, (k, j), (bk, bj), (v,)) for _, op, k, j, bk, bj, v in events], {(k, k % 2): (v,) for k, v in base.items()}
    want, _ = replay.sequential(*model, strict=False)
    assert got == {k: v[0] for k, v in want.items()}
    want, first = replay.sequential(*model)
    clash = [r.event_id // 2 for r in replay.conflicts(steps, key, start).collect()]
    assert (min(clash) if clash else None) == first
    if first is not None:
        steps = steps.where(f"event_id < {first * 2}")
        assert {(r.k, r.j): r.v for r in replay.fold(steps, key, ["v"], start).collect()} == {k: v[0] for k, v in want.items()}


@pytest.mark.parametrize("there", [True, False])
def test_a_row_that_moves_often(spark, there):
    events = [(i, "update", i + 1, i, i) for i in range(37)] + [(37, "update", None, 37, 5), (38, "update", 9, None, 5)]
    log = spark.createDataFrame(events[: 37 if there else 39], "event_id long, op string, k long, b long, v long")
    start = spark.createDataFrame([(0, -1)] if there else [(100, -1)], "k long, v long")
    steps = replay.split_key_changes(replay.settle_key_changes(log, ["k"], ["b"], start), ["k"], ["b"])
    assert [tuple(r) for r in replay.fold(steps, ["k"], ["v"], start).collect()] == ([(37, 36)] if there else [(100, -1)])


def test_empty_log(spark):
    log = spark.createDataFrame([], "event_id long, op string, k long, v long")
    assert replay.fold(log, ["k"], ["v"]).count() == 0
    assert replay.conflicts(log, ["k"]).count() == 0
