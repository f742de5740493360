"""Packing documents into fixed windows by best-fit decreasing.

Documents are tokenised where they lie and cut into pieces, overlong ones into
full windows first; a piece is a row of a few numbers. The pieces, not the texts,
are then dealt by hash into groups of about GROUP, whatever the partitions of the
input were, and each group is packed by itself: longest first, each into the
tightest window that still holds it. A segment tree over remaining capacities
finds that window in O(log capacity). A group comes sorted and leaves as a
stream, so a task holds its open windows only; it wastes at most what its last
few windows leave open.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.llm.common import slices, small_batches, stored, to_batch

WINDOW, END_ID = 2048, 1
#: Distinct pre-tokens whose ids a worker remembers; beyond, the table starts anew.
REMEMBERED = 300_000
#: Pieces that are packed together, about.
GROUP = 16_384
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
SCHEMA = f"{PIECES}, sequence_id long, offset long"


#: The pre-tokenizer's pattern that the quick way stands for; a vocabulary with another is encoded as a whole.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-cased texts of Latin letters, and what keeps a text from that.
QUICK = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
OTHER = re.compile("[^\t\n\v\f\r\x20-\x7e\xa0-\u024f]|[\xb2\xb3\xb9\xbc-\xbe]|<\\|")


class Words:
    """Ids of whole texts, pre-token by pre-token.

    A pre-token's ids depend on nothing else, so they are remembered. Texts of Latin letters are in normal form as they
    are, and Python's own lower case and pattern part them as the vocabulary's would; other texts, and those that may
    hold a special token, go through the tokenizer whole.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(vocabulary)
        steps = json.loads(self._tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        self._quick = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split"] == [PATTERN]
        self._letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self._quick or OTHER.search(text):
            return _bytes(self._tokenizer.encode(text, add_special_tokens=False).ids)
        pieces, known = QUICK.findall(text.lower()), self._known
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for piece in set(pieces):
                if piece not in known:
                    letters = piece if piece.isascii() else self._letters(piece)[0][0]
                    known[piece] = _bytes([t.id for t in self._tokenizer.model.tokenize(letters)])
            return b"".join([known[p] for p in pieces])


def _bytes(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


class Capacities:
    """A segment tree over remaining capacities 0..size; a leaf is a stack of open windows, a node their number."""

    def __init__(self, size: int) -> None:
        self.width = 1 << size.bit_length()
        self.counts = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._count(capacity, 1)

    def _count(self, capacity: int, by: int) -> None:
        i = capacity + self.width
        while i:
            self.counts[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least capacity of need or more, and that capacity; it is removed."""
        i, counts = need + self.width, self.counts
        if not counts[i]:
            while True:  # climb to the first ancestor with something to the right
                if i == 1:
                    return None
                if not i & 1 and counts[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.width:
                i = 2 * i if counts[2 * i] else 2 * i + 1
        capacity = i - self.width
        self._count(capacity, -1)
        return self.windows[capacity].pop(), capacity


class Packer:
    """Best fit for pieces that come longest first."""

    def __init__(self, window: int) -> None:
        self.window, self.used, self._tree = window, 0, Capacities(window)

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) of a piece no longer than the window."""
        found = self._tree.take(length)
        number, room = found or (self.used, self.window)
        self.used += found is None
        if room > length:
            self._tree.add(room - length, number)
        return number, self.window - room


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[tuple[int, int]], int]:
    """(window, offset) of each piece, none longer than window, and the number of windows. Ties keep their order."""
    packer, placed = Packer(window), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        placed[i] = packer.place(lengths[i])
    return placed, packer.used


@lru_cache(maxsize=4)
def words_of(vocabulary: str) -> Words:
    return Words(vocabulary)


def pieces(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of the pieces: full windows, and what is left of each document."""
    fields = to_arrow_schema(StructType.fromDDL(PIECES))
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = words_of(vocabulary), end_id.to_bytes(4, "little")
        for batch in slices(batches):
            out: list[list[int]] = [[] for _ in fields]
            for ident, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = words.ids(text or "") + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    for column, value in zip(out, (ident, start, len(part) // 4, zlib.crc32(part), n), strict=True):
                        column.append(value)
            yield to_batch(out, fields)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(rows, PIECES)


def pack_pieces(cut: DataFrame, n: int, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``cut`` (n rows, as ``pieces`` gives them) with sequence_id and offset.

    The group comes from a hash of the whole row and the order within it from the row, so the packing doesn't depend
    on partitions; rows that are equal in all columns are interchangeable. sequence_id is the group's number in the
    upper bits and the window's in the lower 32.
    """
    names = [f.name for f in StructType.fromDDL(PIECES).fields]
    groups = max(1, round(n / group))
    dealt = cut.select(F.pmod(F.xxhash64(*names), F.lit(groups)).alias("group"), *names)
    tasks = min(groups, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = dealt.repartition(tasks, "group").sortWithinPartitions("group", F.desc("length"), "doc_id", "start", "ids_crc32", "doc_tokens")
    fields = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packer = None, Packer(window)
        for batch in slices(batches, 10_000):
            numbers, offsets = [], []
            for of, length in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if of != now:
                    now, packer = of, Packer(window)
                number, offset = packer.place(length)
                numbers.append((of << 32) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())], schema=fields)

    return order.mapInArrow(rows, SCHEMA)


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, end_id: int = END_ID, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and then ``end_id``, so an empty or null text is one piece of one id. Documents longer than
    a window are first cut into full windows, each a sequence of its own; what is left of them is packed with the
    others. Repeated rows are packed as often as they come, null ids too. Pieces of one length go by id and place. Other
    columns, whatever their names, are left behind. An empty table gives an empty one. A worker holds one very long
    text at a time. The same rows are packed alike however they are partitioned.
    """
    cut = stored(pieces(docs, vocabulary, window, end_id, id_col, text_col), "pieces")
    return pack_pieces(cut, cut.count(), window, group)
