"""Removing passages that repeat across documents: what the two substring operators share.

A passage is a window of W symbols, bytes or words. Every window has an anchor,
its least gram by hash, so equal windows meet in their anchor's group whatever
surrounds them, and at the same distance from the anchor. A text is described by
a light row for each run of windows with one anchor (about 2 / W rows a symbol),
with a hash of the run's symbols, its context. Then, for every group alike:

* groups of one occurrence go, as nothing in them repeats;
* equal contexts (128 bits: a hash of the gram and, by another polynomial, one
  of the context) are one, with its number of occurrences and its first document;
* the distinct contexts are cut from their texts and given to the solver, a
  suffix array or a Lempel-Ziv parse, which compares symbols and is the only
  source of spans. A group's only context needs no symbols: it is a tree of one
  leaf, or a block that its own copies refer to;
* all spans of a context hold its anchor, so their union is one span, which is
  handed to every occurrence of the context.

No task holds a group: those of more than ``part`` distinct contexts, such as
the edges of a passage that a third of all documents have, are solved in parts.
The parts then exchange their windows, by 128 bits of hash with partial
aggregation, and each looks up the windows that it couldn't settle by itself.
Joins are between stored tables, so Spark deals hot keys to several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.llm import hashing
from tideline.llm.common import by_columns, discard, slices, small_batches, stored, to_batch

LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Context:
    """A distinct run of windows. ``data`` has its symbols, ``lead`` of them before the anchor's gram."""

    copies: int
    order: int  # of the first document that has it
    later: bool  # whether a later document has it too
    lead: int
    windows: int
    data: bytes | None  # none for a group's only context


#: Gets an anchor's distinct contexts; gives (context's number, later, start, stop), in symbols from the context's start.
#: ``later`` says which occurrences lose the span: None for all, else those in later documents (True) or in the first (False).
Solver = Callable[[list[Context], int], Iterator[tuple[int, bool | None, int, int]]]


@dataclass(frozen=True)
class Method:
    """window: symbols that must agree. ordered: a window repeats only if an earlier document has it."""

    words: bool
    window: int
    gram: int
    ordered: bool
    solve: Solver
    part: int = 16_384  # about 10 MB of contexts, the most that a task compares at a time

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols for hashing, and the first of each text."""
        if self.words:
            return hashing.words(texts)
        data, bounds = hashing.joined(texts)
        return hashing.BYTES[data], bounds


def squeezed(docs: DataFrame, text: Column, names: list[str]) -> DataFrame:
    """The named columns and ``z``, the text compressed: what a shuffle of whole texts then moves is much less."""
    frame = docs.select(*names, text.alias("z"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]) + ", z binary"
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            column = pa.array([press.compress(t.encode()) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=batch.schema.names)

    return frame.mapInArrow(rows, schema)


ANCHORS = "row long, ord long, start int, windows int, lead int, gram long, context long"


def _anchors(docs: DataFrame, method: Method) -> DataFrame:
    def made(rows: list, orders: list, texts: list) -> list:
        out: list[list[np.ndarray]] = [[] for _ in range(7)]
        raw = [t.encode() for t in texts]
        row, order = np.array(rows, np.int64), np.array(orders, np.int64)
        for a, b in hashing.chunks(raw):
            symbols, bounds = method.symbols(raw[a:b])
            text, start, windows, lead, gram, context = hashing.anchors(symbols, bounds, method.window, method.gram)
            for column, values in zip(out, (row[a:b][text], order[a:b][text], *(x.astype(np.int32) for x in (start, windows, lead)), gram, context), strict=True):
                column.append(values)
        return [np.concatenate(c) if c else [] for c in out]

    return by_columns(docs.select("row", "ord", "text"), made, ANCHORS)


CUT = "gram long, context long, part int, parts int, copies long, first long, later boolean, lead int, windows int, data binary"


def _cut(needed: DataFrame, method: Method) -> DataFrame:
    """The contexts that are asked for, cut from their texts; words are joined by single spaces."""

    def made(texts: list, wanted: list) -> list:
        press = zstandard.ZstdDecompressor()
        out: list[list] = [[] for _ in range(10)]
        names = ("gram", "context", "part", "parts", "copies", "first", "later", "lead", "windows")
        for z, contexts in zip(texts, wanted, strict=True):
            text = press.decompress(z)
            symbols = text.split() if method.words else text
            for w in contexts:
                part = symbols[w["start"] : w["start"] + w["windows"] + method.window - 1]
                for column, name in zip(out, names, strict=False):
                    column.append(w[name])
                out[-1].append(b" ".join(part) if method.words else part)
        return out

    return by_columns(needed, made, CUT)


#: A span has start and stop; a window for the exchange has at, h1, h2 and whether it is still open.
SOLVED = "gram long, context long, first long, later boolean, start int, stop int, at int, h1 long, h2 long, copies long, open boolean"


def _solved(cut: DataFrame, method: Method) -> DataFrame:
    """Spans of the contexts, group by group, and the windows of groups in parts. A task streams its groups and holds a few."""
    fields = to_arrow_schema(StructType.fromDDL(SOLVED))
    n = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = cut.repartition(n, "gram", "part").sortWithinPartitions("gram", "part", "first", "context")

    def spans(rows: list[tuple]) -> list[list]:
        gram, parts = rows[0][0], rows[0][3]
        group = [Context(*r[4:]) for r in rows]
        out: list[list] = [[] for _ in fields]
        found: list[list[tuple[int, int]]] = [[] for _ in group]
        for i, later, start, stop in method.solve(group, method.window):
            if later is not True:
                found[i].append((start, stop))
            _add(out, (gram, rows[i][1], group[i].order, later, start, stop, None, None, None, None, None))
        if parts > 1:
            _publish(rows, group, found, method, out)
        return out

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        out: list[list] = [[] for _ in fields]
        for batch in slices(batches, 10_000):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and (group[0][0] != row[0] or group[0][2] != row[2]):
                    _added(out, spans(group))
                    group = []
                    if len(out[0]) > 20_000:
                        yield to_batch(out, fields)
                        out = [[] for _ in fields]
                group.append(row)
        if group:
            _added(out, spans(group))
        if out[0]:
            yield to_batch(out, fields)

    small_batches(cut.sparkSession)
    return grouped.mapInArrow(solved, SOLVED)


def _added(columns: list[list], more: list[list]) -> None:
    for a, b in zip(columns, more, strict=True):
        a.extend(b)


def _publish(rows: list[tuple], group: list[Context], found: list[list[tuple[int, int]]], method: Method, out: list[list]) -> None:
    """The windows of a part, for the other parts of its group: open ones, within no span of their context, and each other one once."""
    symbols, bounds = method.symbols([c.data or b"" for c in group])
    hashes = [hashing.Ranges(symbols, base) for base in (hashing.BASE, hashing.OTHER_BASE)]
    closed: dict[tuple[int, int], list[int]] = {}
    for i, context in enumerate(group):
        at = np.arange(bounds[i], bounds[i] + context.windows)
        open_ = np.ones(context.windows, bool)
        for start, stop in found[i]:
            open_[start : max(start, stop - method.window + 1)] = False
        keys = list(zip(*(h.hash(at, at + method.window).view(np.int64).tolist() for h in hashes), strict=True))
        for k in np.flatnonzero(open_).tolist():
            _add(out, (rows[0][0], rows[i][1], context.order, None, None, None, k, *keys[k], context.copies, True))
        for k in np.flatnonzero(~open_).tolist():
            known = closed.setdefault(keys[k], [0, context.order])
            known[0], known[1] = known[0] + context.copies, min(known[1], context.order)
    for key, (copies, first) in closed.items():
        _add(out, (rows[0][0], None, first, None, None, None, None, *key, copies, False))


def _add(columns: list[list], row: tuple) -> None:
    for column, value in zip(columns, row, strict=True):
        column.append(value)


def repeated_spans(docs: DataFrame, method: Method) -> DataFrame:
    """row, ord and spans (array of start and stop, in symbols; they may overlap) of the texts that hold repeated windows.

    docs has row and ord (longs; together a key of the text) and text; in an ordered method ord is the documents' order.
    """
    window = method.window
    found = stored(_anchors(docs, method), "anchors")
    groups = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last"), F.min("context").alias("c0"), F.max("context").alias("c1"))
    groups = stored(groups.where("first < last" if method.ordered else "n > 1").select("gram", (F.col("c0") < F.col("c1")).alias("mixed")), "groups")
    shared = stored(found.join(groups, "gram"), "shared")
    discard(found, groups)

    one = F.min(F.struct("ord", "row", "start", "windows", "lead")).alias("one")
    contexts = shared.groupBy("gram", "context").agg(F.first("mixed").alias("mixed"), F.count("*").alias("copies"), F.max("ord").alias("last"), one)
    contexts = contexts.select("gram", "context", "mixed", "copies", "one.*", F.col("one.ord").alias("first"), (F.col("last") > F.col("one.ord")).alias("later"))
    contexts = stored(contexts, "contexts")
    sizes = contexts.where("mixed").groupBy("gram").agg(F.ceil(F.count("*") / method.part).cast("int").alias("parts"))
    large = stored(sizes.where("parts > 1"), "large")
    dealt = contexts.join(large, "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("context"), "parts").cast("int"))
    names = [f.name for f in StructType.fromDDL(CUT).fields[:-1]]
    wanted = dealt.where("mixed").groupBy("row", "ord").agg(F.collect_list(F.struct("start", *names)).alias("wanted"))
    needed = squeezed(docs, F.col("text"), ["row", "ord"]).join(wanted, ["row", "ord"]).select("z", "wanted")
    cut = stored(_cut(needed, method), "cut")
    alone = dealt.where("not mixed").select(*names, F.lit(None).cast("binary").alias("data"))
    solved = stored(_solved(cut.unionByName(alone), method), "solved")
    discard(contexts, large, cut)

    windows = solved.where("h1 is not null")
    nodes = stored(windows.groupBy("gram", "h1", "h2").agg(F.sum("copies").alias("all"), F.min("first").alias("least")).where("true" if method.ordered else "all > 1"), "nodes")
    late = windows.where("open").join(nodes, ["gram", "h1", "h2"]).where("least < first" if method.ordered else "true")
    late = late.select("gram", "context", "first", F.lit(False if method.ordered else None).cast("boolean").alias("later"), F.col("at").alias("start"), (F.col("at") + window).alias("stop"))
    every = solved.where("h1 is null").select("gram", "context", "first", "later", "start", "stop").unionByName(late)
    spans = stored(every.groupBy("gram", "context", "first", "later").agg(F.min("start").alias("from"), F.max("stop").alias("upto")), "spans")
    discard(solved, nodes)

    hit = shared.join(spans, ["gram", "context"]).where("later is null or later = (ord > first)")
    hit = hit.select("row", "ord", (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("upto")).alias("stop"))
    return hit.groupBy("row", "ord").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def covered(spans: list[dict] | None, n: int) -> np.ndarray:
    """A flag for each of n symbols."""
    if not spans:
        return np.zeros(n, bool)
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, [s["start"] for s in spans], 1)
    np.add.at(steps, [s["stop"] for s in spans], -1)
    return np.cumsum(steps[:-1]) > 0


def with_removed(docs: DataFrame, method: Method, id_col: str, text_col: str, remove: Callable[[bytes, list | None], tuple], extra: str) -> DataFrame:
    """docs, each row with what ``remove`` gives for its text and spans (columns ``extra``), its other columns kept as ``rest``.

    A text's key has 128 bits: a hash of id and text with the id, or with another hash where order doesn't matter.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    tie = order if method.ordered else F.xxhash64(text, F.lit("tie"), order)
    rest = F.struct("*").dropFields(text_col) if len(docs.columns) > 1 else F.lit(None)
    keyed = docs.select(F.xxhash64(order, text, F.lit("row")).alias("row"), tie.alias("ord"), text.alias("text"), rest.alias("rest"))
    spans = repeated_spans(keyed.select("row", "ord", "text"), method)
    whole = squeezed(keyed, F.col("text"), ["row", "ord", "rest"]).join(spans, ["row", "ord"], "left").select("rest", "z", "spans")
    kind = whole.schema["rest"].dataType.simpleString()
    schema = f"rest {kind}, {extra}"
    fields = to_arrow_schema(StructType.fromDDL(extra))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in slices(batches, n_bytes=500_000):  # of compressed text
            made = [remove(press.decompress(z), s) for z, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["rest", *fields.names])

    return whole.mapInArrow(rows, schema)
