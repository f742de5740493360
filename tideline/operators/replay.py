"""Replaying a change log as a fold (DM1-DM3, SL2, ER1-ER6, CT3, section 7.3).

Images hold whole rows, so a key's state follows from two of its events: the
last one gives the row, the last insert or delete tells whether it exists.
Both are one aggregation with partial sums, so a key that has a third of all
events costs its partitions a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.plans.store import written


def fold(changes: DataFrame, key: list[str], columns: list[str], base: DataFrame | None = None, op: str = "op", order: str = "event_id") -> DataFrame:
    """Current rows: key and columns. An insert of an existing key overwrites it; updates and deletes of missing ones do nothing.

    Events with a null key match nothing and are left out. ``base`` has the rows before the log, with the same columns.
    """
    folded = _folded(changes, key, columns, op, order)
    if base is None:
        return folded.where("_last = 'insert'").select(*key, *(F.col(f"_row.{c}").alias(c) for c in columns))
    now = _settled(folded, key, columns, base).where("not _gone").drop("_gone")
    return base.select(*key, *columns).join(folded.select(*key), key, "left_anti").unionByName(now)


def changed(changes: DataFrame, key: list[str], columns: list[str], base: DataFrame, op: str = "op", order: str = "event_id") -> DataFrame:
    """What ``fold`` changes in base: key, columns and ``_gone``, a row for each key that is there afterwards or was before.

    Only the keys of base are read; those that no event has may be missing from it.
    """
    return _settled(_folded(changes, key, columns, op, order), key, columns, base)


def _folded(changes: DataFrame, key: list[str], columns: list[str], op: str, order: str) -> DataFrame:
    turn = F.when(F.col(op) != "update", F.col(order))
    return changes.where(_all_set(key)).groupBy(*key).agg(F.max_by(op, turn).alias("_last"), F.max_by(F.struct(*(columns or [order])), order).alias("_row"))


def _settled(folded: DataFrame, key: list[str], columns: list[str], base: DataFrame) -> DataFrame:
    seen = folded.join(base.select(*key).withColumn("_known", F.lit(True)), key, "left")
    stays = (F.col("_last") == "insert") | (F.col("_last").isNull() & F.col("_known"))
    gone = ~F.coalesce(stays, F.lit(False))
    return seen.withColumn("_gone", gone).where("not _gone or _known").select(*key, *(F.col(f"_row.{c}").alias(c) for c in columns), "_gone")


def latest(changes: DataFrame, key: list[str], order: str = "event_id") -> DataFrame:
    """SL2: the last event of each key, whatever it does (compaction of a log)."""
    rest = [c for c in changes.columns if c not in key]
    kept = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return kept.select(*key, *(F.col(f"_row.{c}").alias(c) for c in rest))


def conflicts(changes: DataFrame, key: list[str], base: DataFrame | None = None, op: str = "op", order: str = "event_id") -> DataFrame:
    """CT3, ER1: inserts of a key that exists: the event before among its inserts and deletes is an insert, or base has it."""
    turns = changes.where(_all_set(key) & F.col(op).isin("insert", "delete"))
    before = F.lag(op).over(Window.partitionBy(*key).orderBy(order))
    seen = turns.withColumn("_before", before)
    if base is None:
        return seen.where((F.col(op) == "insert") & (F.col("_before") == "insert")).drop("_before")
    seen = seen.join(base.select(*key).withColumn("_known", F.lit(True)), key, "left")
    clash = F.coalesce(F.col("_before") == "insert", F.col("_known"), F.lit(False))
    return seen.where((F.col(op) == "insert") & clash).drop("_before", "_known")


def cut_at_conflict(changes: DataFrame, key: list[str], table: list[str], base: DataFrame | None = None, op: str = "op", order: str = "event_id") -> DataFrame:
    """ER3, ``continue``: each table's events before its first conflict; the rest of a conflicting table is left out (D: at once)."""
    first = conflicts(changes, [*table, *key], base, op, order).groupBy(*table).agg(F.min(order).alias("_first"))
    return changes.join(first, table, "left").where(F.col("_first").isNull() | (F.col(order) < F.col("_first"))).drop("_first")


def cut_at_exit(changes: DataFrame, key: list[str], table: list[str], base: DataFrame | None = None, op: str = "op", order: str = "event_id") -> DataFrame:
    """ER4, ``exit``: all tables' events before the first conflict of any (D: what is applied isn't applied again)."""
    first = conflicts(changes, [*table, *key], base, op, order).agg(F.min(order).alias("_first"))
    return changes.join(first, F.col("_first").isNull() | (F.col(order) < F.col("_first"))).drop("_first")


def errors(clashes: DataFrame, table: list[str], key: list[str], order: str = "event_id") -> DataFrame:
    """ER2: a row for the error log for each table's first conflict: the table, the event, its key as a predicate, a message."""
    text = F.concat_ws(" AND ", *(F.concat(F.lit(f'"{k}"='), F.coalesce(F.concat(F.lit("'"), F.replace(F.col(k).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))) for k in key))
    first = clashes.withColumn("pkey", text).groupBy(*table).agg(F.min_by("pkey", order).alias("pkey"), F.min(order).alias(order))
    return first.withColumn("message", F.lit("duplicate key value"))


def split_key_changes(changes: DataFrame, key: list[str], before: list[str], op: str = "op", order: str = "event_id") -> DataFrame:
    """H4: updates that change the key as a delete of the old and an insert of the new; ``order`` becomes order * 2 and + 1.

    The old key must exist: ``settle_key_changes`` comes first where it may not.
    """
    moved = _moves(key, before, op)
    steps = F.when(moved, F.array(F.lit("delete"), F.lit("insert"))).otherwise(F.array(F.col(op)))
    out = changes.withColumn("_moved", moved).select("*", F.posexplode(steps).alias("_step", "_op"))
    old = F.col("_moved") & (F.col("_step") == 0)
    for k, b in zip(key, before, strict=True):
        out = out.withColumn(k, F.when(old, F.col(b)).otherwise(F.col(k)))
    return out.withColumn(op, F.col("_op")).withColumn(order, F.col(order) * 2 + F.col("_step")).drop("_moved", "_step", "_op")


def settle_key_changes(changes: DataFrame, key: list[str], before: list[str], base: DataFrame | None = None, op: str = "op", order: str = "event_id") -> DataFrame:
    """H4: changes, in which an update that would move a row that isn't there stays at its old key, where it does nothing.

    Whether a key exists follows from its last insert, delete or move away, or from base, unless moves to it came
    since: then also from any of those that moved a row. A move thus leads to one other at most, the next that takes its
    new key away if no insert or delete comes before, and what moves a row is found along these links by doubling them:
    as many rounds as the logarithm of a row's moves, whatever the size of a component. Only keys of moves are read.
    """
    moves = changes.where(_moves(key, before, op))
    if moves.isEmpty():
        return changes
    new, old = F.struct(*key).alias("_key"), F.struct(*(F.col(b).alias(k) for k, b in zip(key, before, strict=True))).alias("_key")
    at = F.col(order).alias("_at")
    ends = moves.where(_all_set(before)).select(old, at, F.lit("out").alias("_kind")).unionByName(moves.where(_all_set(key)).select(new, at, F.lit("in").alias("_kind")))
    turns = changes.where(_all_set(key) & F.col(op).isin("insert", "delete")).select(new, at, F.col(op).alias("_kind"))
    turns = ends.unionByName(turns.join(ends.select("_key").distinct(), "_key", "left_semi"))

    sure = F.when(F.col("_kind") != "in", F.struct("_kind", "_at"))
    upto = Window.partitionBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("_last", F.last(sure, ignorenulls=True).over(upto.orderBy("_at"))).withColumn("_then", F.last(sure, ignorenulls=True).over(upto.orderBy(F.desc("_at"))))
    outs = turns.where("_kind = 'out'").select("_key", "_at", (F.col("_last._kind") == "insert").alias("_is"))
    known = outs.withColumn("_known", F.lit(False)) if base is None else outs.join(base.select(new, F.lit(True).alias("_known")), "_key", "left")
    ins = turns.where("_kind = 'in'").select("_at", F.when(F.col("_then._kind") == "out", F.col("_then._at")).alias("_next"))
    links = known.select("_at", F.coalesce("_is", "_known", F.lit(False)).alias("_is")).join(ins, "_at", "left")
    links = written(links, "moves")
    while not (reached := links.where("_is and _next is not null")).isEmpty():
        reached = reached.select(F.col("_next").alias("_at"), F.lit(True).alias("_reached")).distinct()
        ahead = links.where("_next is not null").select(F.col("_at").alias("_next"), F.col("_next").alias("_after"))
        links = links.join(reached, "_at", "left").join(ahead, "_next", "left")
        links = links.select("_at", (F.col("_is") | F.coalesce("_reached", F.lit(False))).alias("_is"), F.col("_after").alias("_next"))
        links = written(links, "moves")

    idle = moves.select(order).join(links.where("_is").select(F.col("_at").alias(order)), order, "left_anti")
    out = changes.join(idle.withColumn("_idle", F.lit(True)), order, "left")
    stays = {k: F.when(F.col("_idle"), F.col(b)).otherwise(F.col(k)) for k, b in zip(key, before, strict=True)}
    return out.withColumns(stays).select(*changes.columns)


def counters(changes: DataFrame, by: list[str], skipped: Column, op: str = "op") -> DataFrame:
    """ER5, AG9, AG16, PJ11: replayed, skipped and ddl counts of each batch."""
    ddl = F.col(op) == "ddl"
    return changes.groupBy(*by).agg(F.count_if(~ddl & ~skipped).alias("n_replayed"), F.count_if(~ddl & skipped).alias("n_skipped"), F.count_if(ddl).alias("n_ddl"))


def last_replayed(changes: DataFrame, by: list[str], order: str = "event_id") -> DataFrame:
    """ER6: the source's time of each group's last event."""
    return changes.groupBy(*by).agg(F.max_by("event_time", order).alias("last_time"))


def epochs(log: DataFrame, table: list[str], op: str = "op", order: str = "event_id") -> DataFrame:
    """H8: log with ``epoch``, how many DDL events of its table came up to each event. Tables without DDL stay whole.

    Few events are DDL, so they alone are numbered; other events find theirs among their table's numbers.
    """
    ddl = log.where(F.col(op) == "ddl").groupBy(*table).agg(F.sort_array(F.collect_list(order)).alias("_ddl"))
    upto = F.size(F.filter(F.coalesce("_ddl", F.array().cast("array<bigint>")), lambda d: d <= F.col(order)))
    return log.join(ddl, table, "left").withColumn("epoch", upto.cast("long")).drop("_ddl")


def statement_text(op: Column, table: Column, names: Column, values: Column, keys: Column) -> Column:
    """PJ10, AG5, AG6: an event as the statement it stands for; names, values: arrays of quoted texts; keys: predicates."""
    insert = F.concat(F.lit("INSERT INTO "), table, F.lit(" ("), F.array_join(names, ","), F.lit(") VALUES ("), F.array_join(values, ","), F.lit(")"))
    sets = F.array_join(F.zip_with(names, values, lambda n, v: F.concat(n, F.lit("="), v)), ",")
    where = F.concat(F.lit(" WHERE "), F.array_join(F.array_sort(F.array_distinct(keys)), " AND "))
    return F.when(op == "insert", insert).when(op == "update", F.concat(F.lit("UPDATE "), table, F.lit(" SET "), sets, where)).when(op == "delete", F.concat(F.lit("DELETE FROM "), table, where))


def sequential(rows: list[tuple[str, tuple, tuple | None, tuple | None]], base: dict[tuple, tuple], strict: bool = True) -> tuple[dict[tuple, tuple], int | None]:
    """The model that the fold is tested against: (op, key, old key, row) applied one after the other to a table in memory.

    Returns the table and the index of the first insert that clashed, where a strict replay stops.
    """
    state = dict(base)
    for i, (op, key, old, row) in enumerate(rows):
        if op == "insert":
            if strict and key in state:
                return state, i
            state[key] = row
        elif op == "delete":
            state.pop(key, None)
        elif (old or key) in state:
            if strict and old and old != key and key in state:
                return state, i
            del state[old or key]
            state[key] = row
    return state, None


def _moves(key: list[str], before: list[str], op: str) -> Column:
    """An update that changes the key."""
    out = F.lit(False)
    for k, b in zip(key, before, strict=True):
        out = out | ~F.col(k).eqNullSafe(F.col(b))
    return (F.col(op) == "update") & out


def _all_set(key: list[str]) -> Column:
    out = F.lit(True)
    for k in key:
        out = out & F.col(k).isNotNull()
    return out
