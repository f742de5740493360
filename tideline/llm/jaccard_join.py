"""N-gram Jaccard self-join by signature trees.

A document's set holds its distinct word n-grams, hashed to 64 bits. Equal sets
are one class, so copies never meet. Trees find the links between classes:

1. Blocks. Two classes meet in a block if they agree in a band of two
   min-hashes. ``bands`` is so large that a pair at the threshold misses all
   its blocks with a probability below 1e-11.
2. Coarse trees. Each block's classes form a signature tree: leaves have a
   bitmap of a quarter of their tokens, nodes the OR of their children's and
   the range of their sizes. A dual traversal from the root with itself drops
   each pair of nodes whose greatest possible overlap is below what the
   threshold needs. What is left links classes into clusters, a superset of
   all true links.
3. Fine trees. Each cluster's texts meet once, in trees with bitmaps of all
   tokens; pairs that the traversal leaves are compared set by set. Pairs that
   are connected already are skipped, as components are the result.

Blocks and clusters have no bound, tasks do, so both go in rounds: members meet
within parts of a bounded size; then one member for each component of a part,
again and again while there are parts; then parts that are formed anew by
component and by size. Two parts of one component need not meet, nor two whose
sizes are too far apart, so near copies cost in proportion to their number.

Numbers of links, if asked for, need every pair of a component's classes that the
trees can't rule out: a component's classes are dealt to parts, each two parts meet
in a task, and each task gives one number for each of its classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.llm import hashing
from tideline.llm.common import by_columns, discard, release, small_batches, stored, texts, to_batch
from tideline.llm.components import components
from tideline.llm.substrings import squeezed

FANOUT = 8
COARSE_BITS, FINE_BITS, SAMPLE = 512, 8192, 4
PARTS_CAP, BLOCK_CAP = 128, 512
FEW_TEXTS = 300
LINK_CAP, LINK_SHINGLES = 1024, 1_000_000  # classes, and shingles in all, of a part when links are counted
FEW = 100_000  # rows that may be broadcast; more are joined by a shuffle
MISS = 1e-11


def bands_for(threshold: float, rows: int = 2) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**rows))


def shingles(raw: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted, and the first of each text (and of one more). A-Z are lower-cased."""
    parts = [_shingles(raw[a:b], n) for a, b in hashing.chunks(raw)]
    counts = [np.diff(first) for _, first in parts]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *(t for t, _ in parts)]), np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts]))])


def _shingles(raw: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    words, bounds = hashing.words(raw, lower=True)
    counts = np.diff(bounds)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(raw)), grams)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(grams)])
    start = bounds[text] + np.arange(len(text)) - first[text]
    hashes = hashing.Ranges(words).hash(start, start + np.minimum(n, counts[text]))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(raw) + 1))


def prints(tokens: np.ndarray, first: np.ndarray, random: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit fingerprints of each set; 0 for an empty one."""
    full = np.flatnonzero(np.diff(first))
    out = [np.zeros(len(first) - 1, np.uint64) for _ in range(2)]
    if len(full):
        for k, p in enumerate(out):
            p[full] = np.add.reduceat(hashing.mix(tokens + random[k, 0]), first[full])
    return out


def common(code: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets a and b. code: all sets' tokens as numbers from 0; no set is empty."""
    out, there = np.zeros(len(a), np.int64), np.zeros(int(code.max()) + 1, bool)
    order = np.argsort(a, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        own = code[first[a[at[0]]] : first[a[at[0]] + 1]]
        there[own] = True
        sizes = first[b[at] + 1] - first[b[at]]
        begins = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) + np.repeat(first[b[at]] - begins, sizes)
        out[at] = np.add.reduceat(there[code[place]].astype(np.int64), begins)
        there[own] = False
    return out


def bitmaps(tokens: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap (uint64 words) for each set."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    flags = np.zeros((n, bits), bool)
    flags[row, (tokens % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


class Forest:
    """Signature trees over groups of sets, one tree a group, all traversed together.

    sizes: tokens of each set; maps: bitmaps of those sampled; sampled: their number; labels: sets with one label (0
    or more) need not meet. Members of a group must be neighbours.
    """

    def __init__(self, groups: np.ndarray, sizes: np.ndarray, maps: np.ndarray, sampled: np.ndarray, labels: np.ndarray | None = None) -> None:
        order = np.lexsort((sizes, groups))
        self.order = order
        sizes = sizes[order].astype(np.int64)
        maps = maps[order]
        sampled = sampled[order].astype(np.int64)
        label = np.full(len(order), -1) if labels is None else labels[order]
        spare = sampled - np.bitwise_count(maps).sum(axis=1).astype(np.int64)  # tokens that share a bit
        _, owner = np.unique(groups[order], return_inverse=True)
        #: A level: group, least and greatest size, OR of bitmaps, most tokens without a bit of their own, label, first child.
        self.levels = [(owner, sizes, sizes, maps, spare + sizes - sampled, label, np.arange(len(order) + 1))]
        while len(owner) and len(np.unique(owner)) < len(owner):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            place = np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))
            first = np.flatnonzero(place % FANOUT == 0)
            _, low, high, maps, spare, label, _ = self.levels[-1]
            same = np.minimum.reduceat(label, first) == np.maximum.reduceat(label, first)
            owner = owner[first]
            self.levels.append((owner, np.minimum.reduceat(low, first), np.maximum.reduceat(high, first), np.bitwise_or.reduceat(maps, first, axis=0), np.maximum.reduceat(spare, first), np.where(same, label[first], -1), np.append(first, len(place))))

    def pairs(self, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets (indexes as given) whose overlap may reach num / den of their union, in bounded pieces."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        work = [(top, roots, roots)] if len(roots) else []
        while work:
            depth, a, b = work.pop()
            keep = self._possible(depth, a, b, num, den)
            a, b = a[keep], b[keep]
            if not depth:
                off = a != b
                if off.any():
                    yield self.order[a[off]], self.order[b[off]]
                continue
            begin = self.levels[depth][6]
            for i in range(0, len(a), 4096):
                x, y = self._children(begin, a[i : i + 4096], b[i : i + 4096])
                work.append((depth - 1, x, y))

    @staticmethod
    def _children(begin: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        na, nb = begin[a + 1] - begin[a], begin[b + 1] - begin[b]
        total = na * nb
        which = np.repeat(np.arange(len(a)), total)
        k = np.arange(len(which)) - np.repeat(np.cumsum(total) - total, total)
        x, y = begin[a][which] + k // nb[which], begin[b][which] + k % nb[which]
        keep = (a[which] != b[which]) | (x <= y)
        return x[keep], y[keep]

    def _possible(self, depth: int, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
        _, low, high, maps, spare, label, _ = self.levels[depth]
        keep = (high[a] * den >= num * low[b]) & (high[b] * den >= num * low[a]) & ((label[a] < 0) | (label[a] != label[b]))
        at = np.flatnonzero(keep)
        for i in range(0, len(at), 8192):
            part = at[i : i + 8192]
            x, y = a[part], b[part]
            shared = np.bitwise_count(maps[x] & maps[y]).sum(axis=1).astype(np.int64)
            most = np.minimum(shared + np.minimum(spare[x], spare[y]), np.minimum(high[x], high[y]))
            # overlap / (x + y - overlap) >= num / den needs (num + den) * overlap >= num * (x + y)
            keep[part] = (num + den) * most >= num * (low[x] + low[y])
        return keep


class Union:
    """Disjoint sets of row numbers."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _constants(bands: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, size=(2, 2 * bands), dtype=np.uint64)


SETS = "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>, map binary, sampled int"


def _sets(docs: DataFrame, n: int, bands: int) -> DataFrame:
    """Of each document: the size of its set, its fingerprint, its band keys and its coarse bitmap."""
    random = _constants(bands)

    def made(ids: list, rows: list) -> list:
        raw, out = [t.encode() for t in rows], [[] for _ in range(7)]
        for a, b in hashing.chunks(raw):
            tokens, first = shingles(raw[a:b], n)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            marks = prints(tokens, first, random)
            keys = np.zeros((bands, b - a), np.uint64)
            if len(full):
                for k in range(bands):
                    low = [np.minimum.reduceat((tokens ^ random[0, j]) * (random[1, j] | np.uint64(1)), first[full]) for j in (2 * k, 2 * k + 1)]
                    keys[k, full] = hashing.mix(low[0] + hashing.mix(low[1] + np.uint64(k)))
            some = tokens >> np.uint64(20) & np.uint64(SAMPLE - 1) == 0
            count = np.concatenate([[0], np.cumsum(some)])[first]
            maps = bitmaps(tokens[some], count, COARSE_BITS)
            for column, values in zip(out, (ids[a:b], sizes, *(p.view(np.int64) for p in marks), list(keys.T.copy().view(np.int64)), [m.tobytes() for m in maps], np.diff(count)), strict=True):
                column.extend(values)
        return out

    return by_columns(docs.select("doc_id", "text"), made, SETS)


def _grouped(rows: DataFrame, keys: list[str], made: Callable[[pa.Table], list], schema: str) -> DataFrame:
    """made over the rows of several whole groups at a time; groups are bounded, so a task's memory is."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            if held.num_rows < 2:
                continue
            last = [held.column(k)[held.num_rows - 1].as_py() for k in keys]
            same = np.ones(held.num_rows, bool)
            for k, v in zip(keys, last, strict=True):
                same &= held.column(k).to_numpy() == v
            cut = int(np.argmax(same))  # the last group may go on in the next batch
            if cut:
                yield to_batch(made(held.slice(0, cut)), fields)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield to_batch(made(held), fields)
        release()

    small_batches(rows.sparkSession)
    return dealt.mapInArrow(run, schema)


def _group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


Meet = Callable[[DataFrame, list[str]], DataFrame]


def _coarse(rows: DataFrame, keys: list[str], by: str, num: int, den: int) -> DataFrame:
    """by, doc_id, comp, least: rows whose component, as far as bitmaps can't rule it out, has a lesser comp than theirs."""

    def made(table: pa.Table) -> list:
        groups = _group_numbers(table, keys)
        at = np.flatnonzero(np.bincount(groups)[groups] > 1)
        if not len(at):
            return [[], [], [], []]
        table, owner = table.take(pa.array(at)), groups[at]
        ids, comps = table.column("doc_id").to_numpy(), table.column("comp").to_numpy()
        maps = np.frombuffer(b"".join(table.column("map").to_pylist()), np.uint64).reshape(len(ids), -1)
        labels = _labels(owner, comps)
        union = Union(int(labels.max()) + 1)
        forest = Forest(owner, table.column("n_shingles").to_numpy(), maps, table.column("sampled").to_numpy(), labels)
        for a, b in forest.pairs(num, den):
            for x, y in zip(labels[a].tolist(), labels[b].tolist(), strict=True):
                union.join(x, y)
        least = _least(union, labels, comps)
        far = np.flatnonzero(least < comps)
        return [table.column(by).to_numpy()[far], ids[far], comps[far], least[far]]

    return _grouped(rows.select(*dict.fromkeys([*keys, by, "doc_id", "comp", "n_shingles", "map", "sampled"])), keys, made, f"{by} long, doc_id long, comp long, least long")


def _labels(owner: np.ndarray, comps: np.ndarray) -> np.ndarray:
    """A number for each group's component: its rows are one from the start."""
    return np.unique(np.stack([owner, comps]), axis=1, return_inverse=True)[1].reshape(-1)


def _least(union: Union, labels: np.ndarray, comps: np.ndarray) -> np.ndarray:
    root = np.array([union.find(x) for x in labels.tolist()], np.int64)
    least = np.full(len(union.up), np.iinfo(np.int64).max)
    np.minimum.at(least, root, comps)
    return least[root]


def _fine(rows: DataFrame, keys: list[str], by: str, n: int, num: int, den: int) -> DataFrame:
    """The same by comparing the texts' sets."""

    def made(table: pa.Table) -> list:
        groups = _group_numbers(table, keys)
        ids, comps, of = (table.column(c).to_numpy() for c in ("doc_id", "comp", by))
        press = zstandard.ZstdDecompressor()
        pressed = table.column("z").to_pylist()
        out = []
        for rows in _few_texts(groups):
            tokens, first = shingles([press.decompress(pressed[r]) for r in rows], n)
            sizes = np.diff(first)
            owner = groups[rows]
            labels = _labels(owner, comps[rows])
            union = Union(int(labels.max()) + 1)
            forest = Forest(owner, sizes, bitmaps(tokens, first, FINE_BITS), sizes, labels)
            for a, b in forest.pairs(num, den):
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    p, q = union.find(labels[x]), union.find(labels[y])
                    if p != q:
                        common = len(np.intersect1d(tokens[first[x] : first[x + 1]], tokens[first[y] : first[y + 1]], assume_unique=True))
                        if den * common >= num * (sizes[x] + sizes[y] - common):
                            union.join(p, q)
            least = _least(union, labels, comps[rows])
            far = np.flatnonzero(least < comps[rows])
            out.append((of[rows][far], ids[rows][far], comps[rows][far], least[far]))
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]

    return _grouped(rows.select(*dict.fromkeys([*keys, by, "doc_id", "comp", "z"])), keys, made, f"{by} long, doc_id long, comp long, least long")


def _few_texts(groups: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the groups of two or more: whole groups, up to about FEW_TEXTS rows at a time."""
    at = np.flatnonzero(np.bincount(groups)[groups] > 1)
    begin = 0
    while begin < len(at):
        end = int(np.searchsorted(groups[at], groups[at[begin + FEW_TEXTS]], "right")) if begin + FEW_TEXTS < len(at) else len(at)
        yield at[begin:end]
        begin = end


def _dealt(rows: DataFrame, by: list[str], cap: int, turn: int = 0) -> DataFrame:
    """rows with members (of their group) and part: groups of more than cap members in parts of about cap."""
    sizes = stored(rows.groupBy(*by).agg(F.count("*").alias("members")).where(f"members > {cap}"), "sizes")
    small = F.broadcast(sizes) if sizes.count() <= FEW else sizes
    found = rows.join(small, by, "left").withColumn("members", F.coalesce("members", F.lit(1)))
    return found.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.ceil(F.col("members") / cap)).cast("int"))


def _in_rounds(rows: DataFrame, by: str, cap: int, num: int, den: int, meet: Meet) -> DataFrame:
    """Links (a, b), of comps, that connect what ``meet`` links within the groups of ``by``. rows: by, doc_id, n_shingles and more."""
    links = lambda d: d.select(F.col("comp").alias("a"), F.col("least").alias("b"))
    rows = _dealt(rows, [by], cap).withColumn("comp", F.col("doc_id"))
    one = stored(meet(rows, [by, "part"]), "within")
    split = stored(rows.where(f"members > {cap}").drop("comp", "members", "part"), "split")
    if split.isEmpty():
        return links(one)
    after = split.join(one.select(by, "doc_id", F.col("least").alias("comp")), [by, "doc_id"], "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    after = stored(after, "after")
    # One member for each component of a part, again while there are parts and members become half as many at least.
    heads, turns = after.where("doc_id = comp"), []
    n = heads.count()
    while n:
        dealt = _dealt(heads, [by], cap, len(turns) + 1)
        turns.append(stored(meet(dealt, [by, "part"]).select(by, "comp", "least").distinct(), "heads"))
        heads = stored(dealt.where(f"members > {cap}").drop("members", "part").join(turns[-1], [by, "comp"], "left_anti"), "left")
        before, n = n, heads.count()
        if 2 * n > before:
            break
    joined = after
    for turn in turns:
        joined = joined.join(turn, [by, "comp"], "left").withColumn("comp", F.coalesce("least", "comp")).drop("least")
    joined = stored(joined, "joined")
    discard(split, after)
    # Groups of several components: parts anew, of one component each as far as it fills them, and of one cell of sizes.
    # Sizes that the threshold allows together lie in one cell or in neighbours.
    several = stored(joined.groupBy(by).agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select(by), "several")
    found = links(one)
    for turn in turns:
        found = found.unionByName(links(turn))
    if several.isEmpty():
        return found
    mixed = joined.join(several, by)
    known = stored(mixed.groupBy(by, "comp").agg((F.count("*") >= cap).alias("pure")), "known")
    cell = F.floor(F.log(F.col("n_shingles").cast("double")) / (-math.log(num / den) * 1.0001)).cast("int")
    mixed = mixed.join(known, [by, "comp"]).withColumn("kind", F.when(F.col("pure"), F.col("comp")).otherwise(F.lit(0))).withColumn("cell", cell)
    parts = stored(_dealt(mixed, [by, "pure", "kind", "cell"], cap).drop("members"), "parts")
    names = ["pure", "kind", "cell", "part"]
    listed = parts.select(by, F.struct(*names).alias("p")).distinct()
    met = listed.join(listed.withColumnRenamed("p", "q"), by).where("p <= q and abs(p.cell - q.cell) <= 1 and not (p.pure and q.pure and p.kind = q.kind)")
    meeting = F.xxhash64(by, "p", "q").alias("meeting")
    sides = met.select(by, "p.*", meeting).unionByName(met.where("p <> q").select(by, "q.*", meeting))
    three = stored(meet(parts.join(sides, [by, *names]), ["meeting"]), "across")
    return found.unionByName(links(three))


def _coarse_links(classes: DataFrame, num: int, den: int) -> DataFrame:
    """Links that connect what the pairs of classes do that the coarse trees can't rule out."""
    keyed = classes.select("doc_id", "n_shingles", "map", "sampled", F.posexplode("keys").alias("band", "key")).withColumn("block", F.xxhash64("band", "key")).drop("band", "key")
    return _in_rounds(keyed, "block", BLOCK_CAP, num, den, lambda rows, keys: _coarse(rows, keys, "block", num, den))


def _fine_links(clustered: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Links of components of clustered (cluster, doc_id, n_shingles, z), enough to connect all that belong together."""
    return _in_rounds(clustered, "cluster", PARTS_CAP, num, den, lambda rows, keys: _fine(rows, keys, "cluster", n, num, den))


def _in_classes(clustered: DataFrame, n: int, random: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, f1, f2 and z of each class in clustered, once."""

    def made(ids: list, pressed: list) -> list:
        press = zstandard.ZstdDecompressor()
        tokens, first = shingles([press.decompress(z) for z in pressed], n)
        return [ids, np.diff(first), *(p.view(np.int64) for p in prints(tokens, first, random)), pressed]

    found = by_columns(clustered.select("doc_id", "z"), made, "doc_id long, n_shingles long, f1 long, f2 long, z binary")
    return found.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n_shingles", "z")).alias("r")).select("f1", "f2", "r.*")


def _other_links(classes: DataFrame, kinds: DataFrame, roots: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """f1, f2 and links: of each class, the rows of all other classes that it links with. classes: as of _in_classes."""

    def made(table: pa.Table) -> list:
        groups = _group_numbers(table, keys)
        press = zstandard.ZstdDecompressor()
        pressed = table.column("z").to_pylist()
        weight, f1, f2, p, q, part = (table.column(c).to_numpy() for c in ("weight", "f1", "f2", "p", "q", "part"))
        out = []
        for rows in _few_texts(groups):
            tokens, first = shingles([press.decompress(pressed[r]) for r in rows], n)
            sizes, code = np.diff(first), np.unique(tokens, return_inverse=True)[1]
            links = np.zeros(len(rows), np.int64)
            # Those of one part meet where it meets itself.
            forest = Forest(groups[rows], sizes, bitmaps(tokens, first, FINE_BITS), sizes, np.where(p[rows] == q[rows], -1, part[rows]))
            for a, b in forest.pairs(num, den):
                both = common(code, first, a, b)
                near = den * both >= num * (sizes[a] + sizes[b] - both)
                np.add.at(links, a[near], weight[rows][b[near]])
                np.add.at(links, b[near], weight[rows][a[near]])
            far = np.flatnonzero(links)
            out.append((f1[rows][far], f2[rows][far], links[far]))
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]

    keys = ["comp", "p", "q"]
    found = stored(classes.join(kinds.select("f1", "f2", "weight"), ["f1", "f2"]).join(roots.select(F.col("node").alias("doc_id"), F.col("root").alias("comp")), "doc_id"), "linked")
    parts = F.ceil(F.greatest(F.count("*") / LINK_CAP, F.sum("n_shingles") / LINK_SHINGLES)).cast("int")
    sizes = stored(found.groupBy("comp").agg(parts.alias("parts")).where("parts > 1"), "sizes")
    dealt = found.join(F.broadcast(sizes) if sizes.count() <= FEW else sizes, "comp", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("f1", "f2"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    meeting = dealt.select("comp", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "f1", "f2", "weight", "z")
    return _grouped(meeting, keys, made, "f1 long, f2 long, links long").groupBy("f1", "f2").agg(F.sum("links").alias("links"))


def ngram_jaccard_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", links: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the smallest doc_id that links reach from it, itself included.

    With ``links`` also n_links: how many other rows link with the row itself, copies among them (0 for a null id). A
    component's distinct sets are then compared in pairs as far as the trees can't rule them out: time by the square of
    their number, but no task holds more than two parts of them and no pair leaves a task.

    Two documents link if den * intersection >= num * union of their sets of n-word shingles. A text of fewer words
    has the whole sequence as its one shingle; a null or empty one, or one without words, has an empty set and no links.
    Rows with a null id have a null component and take no part; rows with equal ids are one document, so whatever links
    one links all. An empty table gives an empty one. Other columns, whatever their names, are left behind. Very long
    texts are read in stretches, but a worker holds the shingles of one at a time.
    """
    base = texts(docs, id_col, text_col)
    sets = stored(_sets(base, n, bands_for(num / den)), "sets")
    full = sets.where("n_shingles > 0 and doc_id is not null")
    kinds = stored(full.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight")), "kinds")
    members = stored(full.select("doc_id", "f1", "f2").join(kinds, ["f1", "f2"]).select("doc_id", "rep"), "members")
    if not links:
        discard(kinds)
    # One row for each class: of its member with the least id.
    classes = full.join(members.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    clusters = components(_coarse_links(classes, num, den))
    wanted = clusters.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster")).join(classes.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id")
    clustered = stored(squeezed(base.where("doc_id is not null"), F.col("text"), ["doc_id"]).join(wanted, "doc_id"), "clustered")
    # Rows with one id and several sets tie those sets' classes together.
    tied = members.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").select("doc_id", "b")
    tied = members.join(tied, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    roots = components(_fine_links(clustered, n, num, den).unionByName(tied))
    found = members.join(roots, members["rep"] == roots["node"], "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("component_id"))
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    if not links:
        return sets.select("doc_id", "n_shingles").join(found, "doc_id", "left").select("doc_id", "n_shingles", component)
    others = _other_links(_in_classes(clustered, n, _constants(bands_for(num / den))), kinds, roots, n, num, den)
    counts = kinds.join(others, ["f1", "f2"], "left").select("f1", "f2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    counts = stored(counts.where("n_links > 0"), "counts")
    rows = stored(sets.select("doc_id", "n_shingles", "f1", "f2").join(counts, ["f1", "f2"], "left"), "rows")
    n_links = F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links")
    return rows.join(found, "doc_id", "left").select("doc_id", "n_shingles", component, n_links)
