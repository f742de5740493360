"""Suffix-array dedup: the common-prefix interval tree of an enhanced suffix array.

A repeat of a window or more holds an anchor (see ``substrings``), so the array
needs only the suffixes that begin at an anchor: a sparse suffix array, one for
each anchor's group. A stack scan of its common-prefix lengths gives the tree of
intervals; in each interval the symbols before the anchors, sorted backwards,
tell how far its members agree to the left and where their left extensions
differ. ``maximal_repeats`` reports what can't grow to either side: each maximal
repeat with all of its occurrences. ``remove_repeats`` applies it to whole
tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches
from tideline.llm.substrings import Context, Method, covered, with_removed

WINDOW, GRAM = 200, 32


def common(a: bytes, b: bytes) -> int:
    """Bytes that a and b begin with alike."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(common_prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each interval of two suffixes or more, children before parents.

    common_prefixes[k] is that of suffixes k - 1 and k of the array; the first isn't read.
    """
    stack: list[tuple[int, int]] = []  # depth and first of the intervals that are open
    for k in range(1, len(common_prefixes) + 1):
        now = common_prefixes[k] if k < len(common_prefixes) else -1
        first = k - 1
        while stack and stack[-1][0] > now:
            depth, first = stack.pop()
            yield depth, first, k - 1
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def _array(suffixes: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of the suffixes, and each one's common prefix with the one before it."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    return order, [0] + [common(suffixes[a], suffixes[b]) for a, b in pairwise(order)]


def maximal_repeats(texts: list[tuple[bytes, int]], shortest: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, texts) of each maximal repeat of ``shortest`` bytes or more; texts are (bytes, offset of the anchor).

    The texts listed agree in ``left`` bytes before their anchors and ``right`` bytes from there on. They are all that
    do; with more to the right some drop out (their interval's common prefix), and with more to the left (they differ
    in the byte before, or one begins).
    """
    if len(texts) == 2:
        (a, i), (b, j) = texts
        left, right = common(a[:i][::-1], b[:j][::-1]), common(a[i:], b[j:])
        if left + right >= shortest:
            yield left, right, [0, 1]
        return
    order, prefixes = _array([t[at:] for t, at in texts])
    backwards, agreed = _array([t[:at][::-1] for t, at in texts])
    place = [0] * len(texts)
    for k, i in enumerate(backwards):
        place[i] = k
    most = max((at for _, at in texts), default=0)
    for right, first, last in intervals(prefixes):
        if right + most < shortest:
            continue
        child, of = 0, {order[first]: 0}
        for k in range(first + 1, last + 1):
            child += prefixes[k] == right
            of[order[k]] = child
        members = sorted(of, key=place.__getitem__)
        lefts = [0] + [min(agreed[place[a] + 1 : place[b] + 1]) for a, b in pairwise(members)]
        for left, i, j in intervals(lefts):
            if left + right >= shortest and any(of[m] != of[members[i]] for m in members[i : j + 1]):
                yield left, right, members[i : j + 1]


def solve(group: list[Context], window: int) -> Iterator[tuple[int, bool | None, int, int]]:
    """The span of each context that repeats: as a leaf of several occurrences whole, else as far as its repeats reach."""
    lefts, rights = [-1] * len(group), [0] * len(group)
    if len(group) > 1:
        for left, right, members in maximal_repeats([(c.data or b"", c.lead) for c in group], window):
            for i in members:
                lefts[i], rights[i] = max(lefts[i], left), max(rights[i], right)
    for i, c in enumerate(group):
        if c.copies > 1:
            yield i, None, 0, c.windows + window - 1
        elif lefts[i] >= 0:
            yield i, None, c.lead - lefts[i], c.lead + rights[i]


def _removed(raw: bytes, spans: list | None) -> tuple:
    gone = covered(spans, len(raw))
    kept = raw if not spans else np.frombuffer(raw, np.uint8)[~gone].tobytes()
    runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone]).astype(np.int8)) == 1)) if spans else 0
    return len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs as ``rest`` (its columns but the text), n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes).

    Removed is each byte covered by a ``window``-byte string that also starts anywhere else, in the same text or
    another; all occurrences go, judged on the input. Null and empty texts stay empty. Repeated rows count as
    occurrences of each other, so texts of a window or more that come twice lose everything. Ties need no order. An
    empty table gives an empty one. Columns of any name go along in ``rest``. Very long texts are read in stretches when
    anchors are found; a worker holds one such text at a time. What is kept may cut a UTF-8 sequence.
    """
    method = Method(words=False, window=window, gram=gram, ordered=False, solve=solve)
    return with_removed(docs, method, id_col, text_col, _removed, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_repeats(docs: DataFrame, window: int = WINDOW, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """docs with the repeats cut from its texts; rows that lose all their text are left out.

    Columns are those of docs; n_chars follows the text, if there is one. Bytes of a cut UTF-8 sequence are dropped. A
    text that was null or empty before stays as an empty one.
    """
    out = remove_repeats(docs, window, id_col=id_col, text_col=text_col).where("n_removed < n_bytes or n_bytes = 0")
    small_batches(docs.sparkSession)
    cut = out.select("rest", F.pandas_udf(_decode, "string")("kept").alias("cut"))
    named = [F.col("cut").alias(c) if c == text_col else F.char_length("cut").cast("long").alias(c) if c == "n_chars" else F.col(f"rest.{c}").alias(c) for c in docs.columns]
    return cut.select(*named)


def _decode(kept):  # noqa: ANN001, ANN202 - a pandas series of bytes
    return kept.map(lambda b: b.decode("utf-8", "ignore"))


