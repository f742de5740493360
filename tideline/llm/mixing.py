"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: each source's share of the mix by weight, no more than ``cap`` times
its size; the excess goes to the others by weight (water filling, in closed
form over the sources sorted by the level at which they fill up).

Schedule: slot i has the point frac(i * golden ratio). The points are mapped
through the cumulative targets, so every stretch of the schedule has each
source in proportion. A source's slots are ranked, and rank r takes block
r mod (blocks) of the source's shuffled stream of documents, cut into blocks of
equal tokens; a source that the mix needs more than once is gone through again.

All of it is DataFrame operations. Running sums and ranks go in two levels,
within chunks of bounded size and over the chunks, so no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD, stored

GOLDEN = 0.6180339887498949
WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
BLOCK = 2048  # words a slot
CHUNK = 4096  # slots, or documents on average, that are ranked together
FEW_SOURCES = 10_000  # of up to so many the source table is broadcast, else joined by a shuffle


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *more: Column) -> DataFrame:
    """doc_id, source and size: words of the text, 0 for null; and more columns."""
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), *more)


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """totals (a row a source: source, source_size) with weight, target and ``upto``, the targets' running sum in source order.

    Sources go by code point, null last, and take the weights in turn. A source table is small whatever the corpus;
    its windows are the only ones without a partition.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(names) - 1, F.lit(len(weights)))
    weighed = totals.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int")))
    weighed = weighed.withColumn("full", F.col("source_size") * float(cap)).withColumn("level", F.col("full") / F.col("weight"))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_level.rowsBetween(0, Window.unboundedFollowing)
    # With the sources before this one full, the rest by weight: this one fills up if its own level is below that.
    rest = F.sum("source_size").over(Window.partitionBy()) * float(share) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    turn = F.row_number().over(by_level)  # of sources with one level, the first in order decides
    levelled = weighed.withColumn("rest", rest / F.sum("weight").over(behind)).withColumn("turn", turn)
    level = F.min(F.when(F.col("level") > F.col("rest"), F.struct("turn", "rest"))).over(Window.partitionBy())["rest"]
    filled = levelled.withColumn("target", F.when(level.isNull(), F.col("full")).otherwise(F.least(F.col("full"), F.col("weight") * level)))
    return filled.select("source", "source_size", "weight", "target", F.coalesce(F.sum("target").over(names), F.lit(0.0)).alias("upto"))


def _key(column: str = "source") -> Column:
    """A source's name as a join key that null has too; "+" keeps it apart from every name."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column)), F.lit(""))


def streams(sized: DataFrame, n_docs: int) -> DataFrame:
    """sized with key and ``at``: the words before a document in its source's shuffled stream.

    The order is by a hash of the id (then id and size), so reruns agree. The hash deals a source into chunks of about
    CHUNK documents; sums within chunks and over chunks give the position.
    """
    chunks = max(16, -(-n_docs // CHUNK))
    shuffled = sized.withColumn("key", _key()).withColumn("h", F.xxhash64("doc_id", F.lit("stream"))).withColumn("chunk", F.pmod(F.shiftright("h", 32), F.lit(chunks)).cast("int"))
    sums = shuffled.groupBy("key", "chunk").agg(F.sum("size").alias("total"))
    base = sums.select("key", "chunk", (F.sum("total").over(Window.partitionBy("key").orderBy("chunk")) - F.col("total")).alias("base"))
    inner = Window.partitionBy("key", "chunk").orderBy("h", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    return shuffled.withColumn("inner", F.sum("size").over(inner) - F.col("size")).join(base, ["key", "chunk"]).withColumn("at", F.col("base") + F.col("inner")).drop("base", "inner", "h", "chunk")


def schedule(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix's slots: slot, key, rank, start (words into the source's endless stream) and length.

    plan comes from ``targets``. A source gets as many slots as its target has blocks, the last one shorter. Should
    the schedule's end come before a source has all of its slots, the missing ones follow it.
    """
    spark = plan.sparkSession
    rows = plan.where("target > 0").select(_key().alias("key"), "source_size", F.round("target").cast("long").alias("words"), "target", "upto")
    per = rows.select("key", "words", "target", "upto", F.greatest(F.lit(1), F.round(F.col("source_size") / block)).cast("long").alias("blocks"), "source_size")
    # Slots that the words take when passes are cut into ``blocks`` parts: whole passes, then the part begun last.
    passes = F.floor(F.col("words") / F.col("source_size"))
    part = F.col("words") - passes * F.col("source_size")
    per = per.withColumn("need", (passes * F.col("blocks") + F.ceil(part * F.col("blocks") / F.col("source_size"))).cast("long"))
    per = per.withColumn("from", F.lag("upto", 1, 0.0).over(Window.orderBy("upto", "key")))
    total = per.agg(F.count("*").alias("sources"), F.coalesce(F.sum("need"), F.lit(0)).alias("need"), F.coalesce(F.max("upto"), F.lit(0.0)).alias("upto")).first()
    n = int(total.need * 1.02) + 64 if total.sources else 0
    # A point finds its source among those that share its cell, one of as many equal parts of the whole as there are sources.
    cell = lambda x: F.floor(x * (total.sources / (total.upto or 1.0))).cast("long")
    cells = per.select("key", "from", "upto", F.explode(F.sequence(cell(F.col("from")), cell(F.col("upto")))).alias("cell"))
    few = total.sources <= FEW_SOURCES
    small = F.broadcast if few else lambda d: d
    points = spark.range(n).select(F.col("id").alias("slot"), (F.expr(f"(id * {GOLDEN!r}D) - floor(id * {GOLDEN!r}D)") * F.lit(total.upto)).alias("point")).withColumn("cell", cell(F.col("point")))
    placed = points.join(small(cells), "cell").where("point >= `from` and point < upto").select("slot", "key")
    chunked = placed.withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    counts = chunked.groupBy("key", "chunk").agg(F.count("*").alias("n"))
    base = counts.select("key", "chunk", (F.sum("n").over(Window.partitionBy("key").orderBy("chunk")) - F.col("n")).alias("base"))
    ranked = chunked.withColumn("inner", F.row_number().over(Window.partitionBy("key", "chunk").orderBy("slot"))).join(base, ["key", "chunk"]).select("slot", "key", (F.col("base") + F.col("inner") - 1).alias("rank"))
    had = counts.groupBy("key").agg(F.sum("n").alias("had"))
    late = per.join(had, "key", "left").where("need > coalesce(had, 0)").select(F.lit(n).cast("long").alias("slot"), "key", F.explode(F.expr("sequence(coalesce(had, 0L), need - 1)")).alias("rank"))
    slots = ranked.unionByName(late).join(small(per.select("key", "need", "words", "blocks", "source_size")), "key").where("rank < need")
    turn, number = F.floor(F.col("rank") / F.col("blocks")), F.pmod("rank", "blocks")
    edge = lambda b: F.floor(b * F.col("source_size") / F.col("blocks"))
    begin, end = edge(number), edge(number + 1)
    left = F.col("words") - turn * F.col("source_size")  # words of this pass that the target allows
    return slots.select("slot", "key", "rank", number.alias("block"), begin.alias("begin"), F.least(end, left).alias("end")).where("begin < end")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target (the source's), taken: words of the document that the mix takes, repeats counted,
    and first_slot: where in the schedule it is first taken, null if it isn't.

    Null texts, and texts without words, have size 0 and give nothing. A null source is a source of its own, last in
    order. Sources without words have target 0. Rows with equal or null ids count each for itself; of equal rows, which
    is taken oftener is open. Other columns, whatever their names, are left behind. Very long texts span many blocks. An
    empty table gives an empty one.
    """
    return _mixed(sizes(docs, id_col, text_col, source_col), weights, share, cap, block)


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: docs's rows as often as the mix takes them, the last time in part if it needs only their first words.

    Columns are those of docs; n_chars follows the text, if there is one. Words of a text taken in part are joined by
    single spaces. Rows that the mix doesn't take are left out, as are null texts and those without words. Other columns
    go along, whatever their names.
    """
    sized = sizes(docs, id_col, text_col, source_col, F.struct("*").alias("rest"))
    found = _mixed(sized, weights, share, cap, block, carried=["rest"])
    text = F.col(f"rest.{text_col}")
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    turns = found.where("taken > 0").withColumn("turn", F.explode(F.sequence(F.lit(1), times)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("turn") - 1) * F.col("size"))
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), F.lit(1), words.cast("int")), " ")
    cut = turns.withColumn("cut", F.when(words == F.col("size"), text).otherwise(part))
    named = [F.col("cut").alias(c) if c == text_col else F.char_length("cut").cast("long").alias(c) if c == "n_chars" else F.col(f"rest.{c}").alias(c) for c in docs.columns]
    return cut.select(*named)


def _mixed(sized: DataFrame, weights: tuple[float, ...], share: float, cap: float, block: int, carried: list[str] | None = None) -> DataFrame:
    """carried: columns of sized that go along to the result; they move once, by row."""
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    light = sized.select("doc_id", "source", "size", "row")
    plan = stored(targets(light.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "targets")
    slots = schedule(plan, block)
    # A block is used once or a few times; equal uses of a block are one row with their number.
    uses = slots.groupBy("key", "block", "begin", "end").agg(F.count("*").alias("uses"), F.min("slot").alias("slot"))
    per = plan.select(_key().alias("key"), "source_size", "target", F.greatest(F.lit(1), F.round(F.col("source_size") / block)).cast("long").alias("blocks"))
    small = F.broadcast if plan.count() <= FEW_SOURCES else lambda d: d
    placed = streams(light, sized.count()).join(small(per), "key")
    first = F.floor(F.col("at") * F.col("blocks") / F.col("source_size"))
    last = F.floor((F.col("at") + F.col("size") - 1) * F.col("blocks") / F.col("source_size"))
    # Block b begins at floor(b * size / blocks): one more block at either side allows for that rounding.
    pieces = placed.where("size > 0").select("row", "key", "at", "size", F.explode(F.sequence(F.greatest(first - 1, F.lit(0)), F.least(last + 1, F.col("blocks") - 1))).alias("block"))
    overlap = F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), F.col("end")) - F.greatest("at", "begin"))
    taken = pieces.join(uses, ["key", "block"]).groupBy("row").agg(F.sum(overlap * F.col("uses")).cast("long").alias("taken"), F.min(F.when(overlap > 0, F.col("slot"))).alias("first_slot"))
    out = sized.withColumn("key", _key()).join(small(per), "key").join(taken, "row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", *(carried or []))
