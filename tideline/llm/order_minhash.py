"""Document fingerprints by order MinHash.

A text is a sequence of tokens: its words, longer ones in pieces of up to
PIECE code points. Its k-mers are numbered by occurrence, so the second "a b"
differs from the first. All numbered k-mers are hashed once; the hash deals
them to BINS bins, and in each bin the ELL least are selected, put back in
text order and hashed as a tuple. Texts agree in a bin if they share its
selected k-mers in the same order, which is what makes the signature follow
edit distance rather than set overlap. (One permutation in bins stands for as
many independent permutations; a sort a text replaces one for each.)

Everything is built-in array functions: no shuffle, no Python. ``let`` binds
an intermediate value once; Catalyst would otherwise repeat its expression at
each use within a lambda.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS, ELL, K, PIECE = 32, 2, 2, 12
#: Documents that share a bucket of the neighbour search, on average, and the most bounds of buckets that a plan holds:
#: beyond BUCKET * MOST_BOUNDS documents (500 million) buckets grow, to about 80,000 documents at 20 billion.
BUCKET, MOST_BOUNDS = 2000, 1 << 18


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fingerprint(text: Column, bins: int = BINS, ell: int = ELL, k: int = K, piece: int = PIECE) -> Column:
    """An array of ``bins`` longs, null where a bin selects nothing. A text without words gives nulls only."""
    tokens = F.regexp_extract_all(text, F.lit(f"[^\\x20\\x09-\\x0D]{{1,{piece}}}"), 0)

    def kmers(t: Column) -> Column:
        n = F.greatest(F.size(t) - (k - 1), F.least(F.size(t), F.lit(1)))
        at = lambda i: F.xxhash64(*(F.get(t, i + j) for j in range(k)))
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i).alias("h"), i.alias("i")))).otherwise(F.array())

    def numbered(s: Column) -> Column:
        """s sorted by k-mer, then place: a k-mer's number is its distance from the first of its run."""
        begins = F.filter(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1)["h"] != x["h"]), i)), lambda i: i.isNotNull())
        def runs(b: Column) -> Column:
            stop = lambda j: F.coalesce(F.get(b, j + 1), F.size(s))
            each = lambda begin, j: F.transform(F.slice(s, begin + 1, stop(j) - begin), lambda x, o: F.struct(F.xxhash64(x["h"], o).alias("h"), x["i"].alias("i")))
            return F.flatten(F.transform(b, each))
        return let(begins, runs)

    def chosen(s: Column) -> Column:
        """Of s sorted by hash, those with fewer than ``ell`` before them in their bin."""
        return F.filter(s, lambda x, i: (i < ell) | (_bin(F.get(s, i - ell)["h"], bins) != _bin(x["h"], bins)))

    def tuples(c: Column) -> Column:
        def one(j: Column) -> Column:
            own = F.array_sort(F.transform(F.filter(c, lambda x: _bin(x["h"], bins) == j), lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h"))))
            return let(own, lambda o: F.when(F.size(o) > 0, F.xxhash64(F.transform(o, lambda x: x["h"]))))
        return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), one)

    return let(tokens, lambda t: let(F.array_sort(kmers(t)), lambda s: let(F.array_sort(numbered(s)), lambda o: let(chosen(o), tuples))))


def _bin(h: Column, bins: int) -> Column:
    """The bin of a hash by its upper bits, so that bins are runs of the sorted hashes."""
    return F.shiftrightunsigned(h, 64 - (bins - 1).bit_length())


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among those that either text fills; 1 for two texts without words, 0 if only one has none."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    used = F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(used == 0, F.lit(1.0)).otherwise(same / used)


def as_text(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), ".")


def with_next(docs: DataFrame, carried: list[str], id_col: str = "doc_id", tie: str = "text") -> DataFrame:
    """docs with ``next``, a struct of the carried columns of the document with the next smaller id; the last one gets the first's.

    Documents are ordered by id and a hash of ``tie``, null ids last. One in BUCKET of them, chosen by hash, is the
    first of a bucket, and goes as a guest to the bucket before it too, where the last row finds it. So ids and their
    gaps don't matter, and rows with equal or null ids fall into many buckets; only rows that are equal in both stay
    together. Bounds are 16 bytes each and one constant of the plan. A column ``next`` of docs is replaced.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    key = F.struct(order.alias("o"), F.xxhash64(tie).alias("c"))
    n = docs.count()
    chosen = F.when(F.pmod(F.xxhash64("k.c", "k.o"), F.lit(max(BUCKET, -(-n // MOST_BOUNDS)))) == 0, F.col("k"))
    found = docs.select(key.alias("k")).agg(F.max("k").alias("top"), F.array_sort(F.collect_set(chosen)).alias("bounds")).first()
    bounds, top = _constant([(b.o, b.c) for b in found.bounds]), _constant([tuple(found.top)] if n else [])
    whole = docs.drop("next").select(F.struct("*").alias("d"), key.alias("k"))
    placed = whole.withColumn("bucket", _below(bounds, len(found.bounds), F.col("k")))
    guest = F.when(F.get(bounds, F.col("bucket")) == F.col("k"), F.struct((F.col("bucket") + 1).alias("b"), F.lit(True).alias("only")))
    wrap = F.when(F.get(top, F.lit(0)) == F.col("k"), F.struct(F.lit(0).alias("b"), F.lit(True).alias("only")))
    own = F.struct(F.col("bucket").alias("b"), F.lit(False).alias("only"))
    both = placed.withColumn("place", F.explode(F.filter(F.array(own, guest, wrap), lambda p: p.isNotNull())))
    window = Window.partitionBy("place.b").orderBy(F.col("place.only"), F.desc("k.o"), F.desc("k.c"))
    return both.withColumn("next", F.lead(F.struct(*(F.col(f"d.{c}") for c in carried))).over(window)).where("not place.only").select("d.*", "next")


def _constant(pairs: list[tuple[int, int]]) -> Column:
    """Pairs of longs as an array that is one folded constant."""
    return F.from_json(F.lit(json.dumps([{"o": o, "c": c} for o, c in pairs])), "array<struct<o: bigint, c: bigint>>")


def _below(bounds: Column, n: int, key: Column) -> Column:
    """How many of n sorted bounds are below key: among every 4096th, then every 64th of those left, then the rest."""
    smaller = lambda b: b < key
    every = lambda step: F.transform(F.sequence(F.lit(step - 1), F.lit(n - 1), F.lit(step)), lambda i: F.get(bounds, i)) if n >= step else None
    within = lambda heads, at: F.lit(0) if heads is None else F.size(F.filter(F.slice(heads, at * 64 + 1, F.lit(64)), smaller))
    first = F.lit(0) if n < 4096 else F.size(F.filter(every(4096), smaller))
    if not n:
        return F.lit(0)
    return let(first, lambda a: let(a * 64 + within(every(64), a), lambda b: b * 64 + within(bounds, b)))


def fingerprints(docs: DataFrame, bins: int = BINS, ell: int = ELL, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last third replaced by the beginning of the next document's. Null texts count as empty;
    an empty text has a fingerprint of empty bins and is like another such text. Equal texts have equal fingerprints. A
    single row is its own next document. Rows of one id follow each other by a hash of their texts, null ids come after
    all others. Other columns, whatever their names, are left behind. An empty table gives an empty one.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    printed = base.withColumn("p", fingerprint(F.col("text"), bins, ell, k))
    n, third = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - int(floor(char_length(text) / 3)))"), F.substring(F.col("next.text"), F.lit(1), third))
    paired = with_next(printed, ["text", "p"]).withColumn("edited", edited).withColumn("q", fingerprint(F.col("edited"), bins, ell, k))
    return paired.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("p")).alias("fingerprint"), as_text(F.col("q")).alias("edited_fingerprint"), likeness(F.col("p"), F.col("q")).alias("near_edited"), likeness(F.col("p"), F.col("next.p")).alias("near_next"))
