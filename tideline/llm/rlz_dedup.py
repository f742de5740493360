"""Substring dedup by relative Lempel-Ziv parsing.

Texts are factored greedily against reference blocks: the indexed contexts of
earlier documents that share an anchor (see ``substrings``). A factor of the
full window or more is a duplicate span. Windows that straddle a factor's end
can match elsewhere, so each start there is looked up by itself; starts within
a factor need no look-up. That makes the parse exact. Words are compared as
such. A context that later documents have again is a factor of theirs as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from tideline.llm.hashing import SPACE
from tideline.llm.substrings import Context, Method, covered, with_removed

WINDOW, GRAM = 50, 8


class Reference:
    """Blocks of words with an index of their windows; each window leads to the earliest document that has it."""

    def __init__(self, window: int) -> None:
        self.window = window
        self._blocks: list[tuple[int, list[bytes]]] = []
        self._index: dict[bytes, tuple[int, int]] = {}

    def _windows(self, words: list[bytes]) -> list[bytes]:
        return [b" ".join(words[at : at + self.window]) for at in range(len(words) - self.window + 1)]

    def add(self, order: int, block: list[bytes]) -> None:
        """Blocks come in ascending order of their documents."""
        number = len(self._blocks)
        self._blocks.append((order, block))
        for at, window in enumerate(self._windows(block)):
            self._index.setdefault(window, (number, at))

    def factors(self, order: int, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, length) of the factors of words that reach the window and lie in earlier documents."""
        at, windows = 0, self._windows(words)
        while at < len(windows):
            number, place = self._index.get(windows[at], (-1, 0))
            if number < 0 or self._blocks[number][0] >= order:
                at += 1
                continue
            block = self._blocks[number][1]
            more = _agreeing(words, at + self.window, block, place + self.window)
            yield at, self.window + more
            at += more + 1  # the first start whose window crosses the factor's end


def _agreeing(a: list[bytes], i: int, b: list[bytes], j: int) -> int:
    """Words that a from i on and b from j on begin with alike."""
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    return n


def solve(group: list[Context], window: int) -> Iterator[tuple[int, bool | None, int, int]]:
    """Duplicate spans of the contexts, parsed in the order of their first documents against those before them."""
    reference = Reference(window)
    for i in sorted(range(len(group)), key=lambda i: group[i].order):
        context = group[i]
        if len(group) > 1:
            words = (context.data or b"").split(b" ")
            for start, length in reference.factors(context.order, words):
                yield i, False, start, start + length
            reference.add(context.order, words)
        if context.later:
            yield i, True, 0, context.windows + window - 1


def words_of(raw: bytes) -> list[bytes]:
    return raw.split()  # ASCII white space: what SPACE marks


def _removed(raw: bytes, spans: list | None) -> tuple:
    words = words_of(raw)
    gone = covered(spans, len(words))
    kept = b" ".join(words if not spans else [w for w, g in zip(words, gone, strict=True) if not g])
    return len(words), int(np.count_nonzero(gone)), hashlib.sha256(kept).hexdigest(), kept


def remove_duplicates(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs as ``rest`` (its columns but the text), n_words, n_removed, kept_sha256 and kept (bytes).

    Removed is each word covered by a window of ``window`` words whose sequence also starts in a document with a
    smaller id, judged on the input; kept words are joined by single spaces. Null and empty texts have no words. Rows
    with equal ids, such as repeated rows, don't remove each other's words; null ids count as the largest. An empty table
    gives an empty one. Columns of any name go along in ``rest``. Very long texts are read in stretches when anchors are
    found; a worker holds one such text at a time.
    """
    method = Method(words=True, window=window, gram=gram, ordered=True, solve=solve)
    return with_removed(docs, method, id_col, text_col, _removed, "n_words long, n_removed long, kept_sha256 string, kept binary")


assert bytes(np.flatnonzero(SPACE).astype(np.uint8)) == b"\t\n\x0b\x0c\r "
