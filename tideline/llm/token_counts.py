"""Token counts that follow edits.

A document is kept as a binary tree over runs of its pre-tokens (the pieces that
byte-pair encoding never crosses). Every node has the characters and tokens of
its subtree, so a place is found, and a sum updated, along one path. An edit
replaces a span of characters. Only the runs it touches, and as much context
after it as the pre-token pattern needs to fall back into step with the old
boundaries, are split and encoded anew: the first of these leaves takes what
comes out, the others become empty, and the sums above them are updated. A leaf
that grew long becomes a subtree. Nothing else is read or moved.

Why this is exact: the pattern matches from left to right without looking
back, so what follows a boundary depends only on the text from there on. The
run before the edit is split anew too, since a match may look one character
ahead (``\\s+(?!\\S)``). Once a new boundary behind the edit meets the end of an
old run, all later ones agree.

``trees`` makes the trees of a table's documents, as a column that can be kept;
``recount`` applies a table of edits to kept trees. ``count_tokens`` does both in
one pass for edits that a function gives.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideline.llm.common import by_columns, columns_of, slices, to_batch

#: Distinct pre-tokens whose counts a worker remembers; beyond, the table starts anew.
REMEMBERED = 300_000


class Counter:
    """Token counts of pre-tokens under a public byte-level vocabulary file."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.split = regex.compile(pattern).findall
        self._known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self._known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for p in set(pieces):
                if p not in known:
                    known[p] = len(self._encode(p))
            return [known[p] for p in pieces]


class Node:
    """chars and tokens of a subtree; a leaf has its text and no children."""

    __slots__ = ("chars", "tokens", "pieces", "text", "left", "right", "up")

    def __init__(self) -> None:
        self.chars = self.tokens = self.pieces = 0
        self.text, self.up = "", None
        self.left = self.right = None

    def fill(self, text: str, tokens: int, pieces: int) -> None:
        self.text, self.chars, self.tokens, self.pieces = text, len(text), tokens, pieces
        self.left = self.right = None

    def sum(self) -> None:
        a, b = self.left, self.right
        self.chars, self.tokens, self.pieces = a.chars + b.chars, a.tokens + b.tokens, a.pieces + b.pieces


class Tree:
    """A document's runs of RUN pre-tokens. ``visited`` counts the nodes that edits read or changed."""

    RUN = 16

    def __init__(self, runs: list[tuple[str, int, int]]) -> None:
        """runs: text, tokens and pre-tokens of each."""
        self.root, self.visited = Node(), 0
        self._build(self.root, runs)

    @classmethod
    def of(cls, text: str, counter: Counter) -> "Tree":
        return cls(cls.runs_of(counter.split(text), counter))

    @classmethod
    def runs_of(cls, pieces: list[str], counter: Counter) -> list[tuple[str, int, int]]:
        counts, n = counter.counts(pieces), cls.RUN
        return [("".join(pieces[i : i + n]), sum(counts[i : i + n]), len(pieces[i : i + n])) for i in range(0, len(pieces), n)]

    def _build(self, node: Node, runs: list[tuple[str, int, int]]) -> None:
        """A balanced subtree of the runs at node; nothing above it changes."""
        level = []
        for run in runs or [("", 0, 0)]:
            leaf = Node()
            leaf.fill(*run)
            level.append(leaf)
        while len(level) > 1:
            pairs = []
            for i in range(0, len(level) - 1, 2):
                top = Node()
                self._adopt(top, level[i], level[i + 1])
                pairs.append(top)
            level = pairs + level[len(level) - len(level) % 2 :]
        made = level[0]
        node.chars, node.tokens, node.pieces, node.text = made.chars, made.tokens, made.pieces, made.text
        node.left, node.right = made.left, made.right
        for child in (node.left, node.right):
            if child is not None:
                child.up = node

    @staticmethod
    def _adopt(top: Node, left: Node, right: Node) -> None:
        top.left, top.right = left, right
        left.up = right.up = top
        top.sum()

    @property
    def total(self) -> int:
        return self.root.tokens

    @property
    def length(self) -> int:
        return self.root.chars

    def _find(self, at: int) -> tuple[Node, int]:
        """The leaf that holds character ``at``, the last one for the text's end, and its first character."""
        node, begin = self.root, 0
        while node.left is not None:
            self.visited += 1
            if at < begin + node.left.chars or (not node.right.chars and at <= begin + node.left.chars):
                node = node.left
            else:
                begin += node.left.chars
                node = node.right
        return node, begin

    def _next(self, leaf: Node) -> Node | None:
        """The next leaf that isn't empty."""
        return self._beside(leaf, "left", "right")

    def _before(self, leaf: Node) -> Node | None:
        return self._beside(leaf, "right", "left")

    def _beside(self, node: Node, near: str, far: str) -> Node | None:
        while node.up is not None:
            self.visited += 1
            top = node.up
            if getattr(top, near) is node and getattr(top, far).chars:
                node = getattr(top, far)
                while node.left is not None:
                    self.visited += 1
                    node = getattr(node, near) if getattr(node, near).chars else getattr(node, far)
                return node
            node = top
        return None

    def edit(self, at: int, removed: int, added: str, counter: Counter) -> int:
        """Replace ``removed`` characters at ``at`` by ``added``. Returns how many pre-tokens were encoded anew."""
        if not 0 <= at <= at + removed <= self.length:
            raise ValueError("the edit lies outside the text")
        leaf, begin = self._find(at)
        before = self._before(leaf)
        if before is not None:
            leaf, begin = before, begin - before.chars
        touched, end = [leaf], begin + leaf.chars
        while end <= at + removed and (after := self._next(touched[-1])) is not None:
            touched.append(after)
            end += after.chars
        while True:
            old = "".join(n.text for n in touched)
            region = old[: at - begin] + added + old[at + removed - begin :]
            after = self._next(touched[-1])
            if after is None:
                pieces = counter.split(region)
                break
            pieces = self._split_to(counter, region, after.text)
            if pieces is not None:
                break
            for _ in range(len(touched)):  # twice as many, until boundaries meet
                if (after := self._next(touched[-1])) is None:
                    break
                touched.append(after)
        self._replace(touched, self.runs_of(pieces, counter))
        return len(pieces)

    @staticmethod
    def _split_to(counter: Counter, region: str, behind: str) -> list[str] | None:
        """The pre-tokens of region, or None if none of the new boundaries falls on its end, given the text behind it."""
        out, at = [], 0
        for piece in counter.split(region + behind):
            if at >= len(region):
                break
            out.append(piece)
            at += len(piece)
        # A match that ends with what was looked at could have gone on: then more text is needed.
        return out if at == len(region) else None

    def _replace(self, leaves: list[Node], runs: list[tuple[str, int, int]]) -> None:
        for leaf in leaves[1:]:
            leaf.fill("", 0, 0)
        share = -(-len(runs) // len(leaves)) if len(runs) > 1 else 1
        for i, leaf in enumerate(leaves):  # as many runs to each as come out even; a leaf of several is a subtree
            own = runs[i * share : (i + 1) * share]
            if own:
                self._build(leaf, own)
            else:
                leaf.fill("", 0, 0)
        level = {id(n.up): n.up for n in leaves if n.up is not None}
        while level:
            self.visited += len(level)
            for node in level.values():
                node.sum()
            level = {id(n.up): n.up for n in level.values() if n.up is not None}
        if self._depth(leaves[0]) > 2 * max(1, self.root.pieces).bit_length() + 8:
            self._build(self.root, list(self.leaves()))  # many edits at one place: level the tree again

    def _depth(self, node: Node) -> int:
        n = 0
        while node.left is not None:
            node, n = node.left, n + 1
        while node.up is not None:
            node, n = node.up, n + 1
        return n

    def leaves(self) -> Iterator[tuple[str, int, int]]:
        """Text, tokens and pre-tokens of each run that isn't empty."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.left is not None:
                stack += [node.right, node.left]
            elif node.chars:
                yield node.text, node.tokens, node.pieces

    @property
    def text(self) -> str:
        return "".join(t for t, _, _ in self.leaves())


@lru_cache(maxsize=4)
def counter_of(vocabulary: str, pattern: str) -> Counter:
    return Counter(vocabulary, pattern)


Edit = tuple[int, int, str]


def default_edits(text: str) -> list[Edit]:
    """Three edits that any text allows: an insertion at a third, a deletion in the middle, a replacement near the end."""
    n = len(text)
    note, cut, swap = " (revised 2024) ", min(40, n // 4), min(8, n // 8)
    return [(n // 3, 0, note), (n // 2, cut, ""), (n + len(note) - cut - swap - n // 10, swap, "Annex B")]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, edits: Callable[[str], list[Edit]] = default_edits, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens of the whole text, n_tokens_edited after the edits, n_pretokens, n_reencoded (pre-tokens encoded anew).

    A null text counts as empty. ``edits`` gives (offset, removed, added) for a text, applied in turn, offsets in the
    text as it then is. Rows are independent: repeated rows give repeated results, null ids stay, an empty table gives an
    empty one. Other columns, whatever their names, are left behind. A worker holds one very long text at a time.
    Pieces of a text with lone surrogates can't occur, as columns hold valid UTF-8.
    """

    def rows(idents: list, texts: list) -> list:
        counter, out = counter_of(vocabulary, pattern), []
        for ident, text in zip(idents, texts, strict=True):
            tree = Tree.of(text or "", counter)
            before, n, anew = tree.total, tree.root.pieces, 0
            for at, removed, added in edits(text or ""):
                anew += tree.edit(at, removed, added, counter)
            out.append((ident, before, tree.total, n, anew))
        return columns_of(out, 5)

    return by_columns(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), rows, "doc_id long, n_tokens long, n_tokens_edited long, n_pretokens long, n_reencoded long")


TREES = "doc_id long, text string, n_tokens long, run_chars binary, run_tokens binary, run_pretokens binary"


def _kept(ident: int | None, tree: Tree) -> tuple:
    runs = list(tree.leaves())
    packed = [np.array(x, "<u4").tobytes() for x in ([len(t) for t, _, _ in runs], [n for _, n, _ in runs], [n for _, _, n in runs])]
    return (ident, "".join(t for t, _, _ in runs), tree.total, *packed)


def _loaded(text: str, chars: bytes, tokens: bytes, pretokens: bytes) -> Tree:
    """A kept tree. Nothing is split or encoded."""
    sizes = np.frombuffer(chars, "<u4")
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return Tree([(text[e - n : e], t, p) for e, n, t, p in zip(ends, sizes.tolist(), np.frombuffer(tokens, "<u4").tolist(), np.frombuffer(pretokens, "<u4").tolist(), strict=True)])


def trees(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's tree, to be kept: doc_id, text, n_tokens and the characters, tokens and pre-tokens of its runs.

    A null text counts as empty; an empty table gives an empty one; other columns are left behind.
    """

    def rows(idents: list, texts: list) -> list:
        counter = counter_of(vocabulary, pattern)
        return columns_of([_kept(i, Tree.of(t or "", counter)) for i, t in zip(idents, texts, strict=True)], 6)

    return by_columns(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), rows, TREES)


def recount(kept: DataFrame, edits: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``kept`` (from ``trees``) after a table of edits (doc_id, turn, at, removed, added), with n_reencoded and n_refused.

    A document's edits are applied by ``turn``, offsets in the text as it then is; a null ``removed`` is 0 and a null
    ``added`` empty. One that lies outside the text, or has no offset, is counted in n_refused and does nothing. Edits of
    ids that no tree has, or of null ids, do nothing either. Ids of trees are a key: of equal ones each gets no edits but
    the last. Trees and edits come to one task sorted, and stream through it: it holds one document, however many edits
    that has.
    """
    fields = to_arrow_schema(StructType.fromDDL(f"{TREES}, n_reencoded long, n_refused long"))
    none = F.lit(None)
    a = kept.select("doc_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("long").alias("at"), none.cast("long").alias("removed"), "text", "run_chars", "run_tokens", "run_pretokens")
    b = edits.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), F.col("at").cast("long").alias("at"), F.col("removed").cast("long").alias("removed"), F.col("added").cast("string").alias("text"), *(none.cast("binary").alias(c) for c in ("run_chars", "run_tokens", "run_pretokens")))
    n = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = a.unionByName(b).repartition(n, "doc_id").sortWithinPartitions("doc_id", "kind", "turn", "at", "removed", "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, now, tree, done = counter_of(vocabulary, pattern), None, None, []
        anew = refused = 0
        for batch in slices(batches):
            for ident, kind, _, at, removed, text, chars, tokens, pretokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if tree is not None:
                        done.append((*_kept(now, tree), anew, refused))
                    now, tree, anew, refused = ident, _loaded(text, chars, tokens, pretokens), 0, 0
                elif tree is not None and ident == now:
                    try:
                        anew += tree.edit(-1 if at is None else at, removed or 0, text or "", counter)
                    except ValueError:
                        refused += 1
            if done:
                yield to_batch(columns_of(done, 8), fields)
                done = []
        if tree is not None:
            yield to_batch(columns_of([(*_kept(now, tree), anew, refused)], 8), fields)

    return both.mapInArrow(rows, f"{TREES}, n_reencoded long, n_refused long")
