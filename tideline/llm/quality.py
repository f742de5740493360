"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Terms are byte trigrams and word shapes, hashed to TERMS counts. A bounded
sample of labelled rows (``sample`` a class, the least by hash of the id) gives
the inverse document frequencies, a truncated singular value decomposition of
its weighted counts, and the labelled vectors. These and the projection are of
fixed size and are broadcast. Every document of the corpus is then projected,
compared with every labelled vector in blocks of exact cosine products, and
scored by its nearest neighbours' labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import hashing
from tideline.llm.common import by_columns, release, slices, small_batches

TERMS, RANK, NEIGHBOURS, SAMPLE, SHARPNESS = 2048, 48, 25, 1500, 8

#: Byte classes for word shapes: lower, upper, digit, space, and each other byte as itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[97:123], SHAPE[65:91], SHAPE[48:58], SHAPE[128:] = 97, 65, 48, 128
SHAPE[hashing.SPACE] = 32


def term_counts(raw: list[bytes]) -> np.ndarray:
    """TERMS counts for each text: half for trigrams of bytes, half for four bytes' shapes."""
    data, bounds = hashing.joined(raw, b" ")
    out = np.zeros((len(raw), TERMS), np.float32)
    if not len(data):
        return out
    text = np.repeat(np.arange(len(raw)), np.diff(bounds))[: len(data)]
    half = TERMS // 2
    for width, symbols, base in ((3, hashing.LOWER[data], 0), (4, SHAPE[data], half)):
        n = len(data) - width + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint64)
        for i in range(width):
            code = (code << np.uint64(8)) | symbols[i : i + n].astype(np.uint64)
        term = (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - half.bit_length() + 1)).astype(np.int64) + base
        inside = text[:n] == text[width - 1 : width - 1 + n]
        out += np.bincount(text[:n][inside] * TERMS + term[inside], minlength=len(raw) * TERMS).reshape(len(raw), TERMS).astype(np.float32)
    return out


@dataclass(frozen=True)
class Model:
    idf: np.ndarray  # TERMS
    axes: np.ndarray  # TERMS x RANK
    vectors: np.ndarray  # labelled rows x RANK, of length 1 or 0
    labels: np.ndarray  # 0 or 1
    weights: np.ndarray  # what a vote of a row counts, so that the sample's classes stand for all labelled rows
    prior: float

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, totals: tuple[int, int], rank: int = RANK) -> "Model":
        if not len(labels):
            return cls(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, np.zeros(0), 0.5)
        idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        weighed = _weighed(counts, idf)
        axes = _axes(weighed, rank)
        seen = np.bincount(labels, minlength=2)
        weights = np.array([totals[k] / max(1, seen[k]) for k in labels])
        return cls(idf, axes, _unit(weighed @ axes), labels, weights, totals[1] / max(1, sum(totals)))

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The weighted share of label 1 among the nearest; the prior for texts without terms."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        vectors = _unit(_weighed(counts, self.idf) @ self.axes)
        k = min(neighbours, len(self.labels))
        out = np.empty(len(counts))
        for at in range(0, len(counts), 512):
            block = vectors[at : at + 512]
            cosines = block @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k] if k < len(self.labels) else np.broadcast_to(np.arange(k), (len(block), k))
            alike = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS * self.weights[near]
            total = alike.sum(axis=1)
            out[at : at + 512] = np.where(total > 0, (alike * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300), self.prior)
        return np.clip(out, 0, 1)


def _axes(weighed: np.ndarray, rank: int, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration: unlike a full decomposition it needs next to no memory."""
    start = np.random.default_rng(5).standard_normal((weighed.shape[1], min(rank + 16, *weighed.shape)))
    space, _ = np.linalg.qr(start.astype(np.float32))
    for _ in range(rounds):
        space, _ = np.linalg.qr(weighed.T @ (weighed @ space))
    seen = (weighed @ space).astype(np.float64)
    _, turns = np.linalg.eigh(seen.T @ seen)
    return space @ turns[:, ::-1][:, :rank].astype(np.float32)


def _weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    made = np.log1p(counts)
    made *= idf
    return _unit(made)


def _unit(x: np.ndarray) -> np.ndarray:
    """x with rows of length 1 (or 0), in place."""
    size = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    x /= np.where(size > 0, size, 1)
    return x


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are kept from training: crc32 of the id's digits, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from up to ``sample`` labelled rows of each class that aren't held out.

    Null labels and ids are left out; an id with several labels takes the least. Nothing but the text is an input.
    """
    rows = labels.where(~held_out(id_col)).where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"))
    totals = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    pick = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = F.broadcast(pick[0].unionByName(pick[1]))  # 2 * sample rows at most
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(chosen, "doc_id")

    def made(ids: list, texts: list, given: list) -> list:
        counts = np.minimum(term_counts([t.encode() for t in texts]), 65535).astype(np.uint16)
        return [ids, given, [c.tobytes() for c in counts]]

    got = by_columns(found.select("doc_id", "text", "label"), made, "doc_id long, label int, counts binary").groupBy("doc_id").agg(F.min("label").alias("label"), F.min_by("counts", "counts").alias("counts")).orderBy("doc_id").collect()
    counts = np.zeros((len(got), TERMS), np.float32)
    for row, r in zip(counts, got, strict=True):
        row[:] = np.frombuffer(r.counts, np.uint16)
    given = np.array([r.label for r in got], np.int64)
    del got
    model = Model.fit(counts, given, (totals.get(0, 0), totals.get(1, 0)))
    del counts
    release()
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs, each row with a column ``score_col``; a null text is scored as an empty one. A column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != score_col.lower()]
    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_scored_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [t.encode() for t in batch.column(batch.num_columns - 1).to_pylist()]
            parts = [shared.value.scores(term_counts(raw[a:b])) for a, b in hashing.chunks(raw)]
            score = pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names=[*kept, score_col])

    return given.mapInArrow(rows, f"{kinds}, `{score_col}` double")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 up) of every row of docs.

    Without labelled rows every score is 0.5. A null or empty text has the labels' prior. Repeated rows are scored alike;
    null ids stay and aren't held out; an empty table gives an empty one. Other columns, whatever their names, are left
    behind. Very long texts are counted by themselves, one at a time.
    """
    model = fit(docs, labels, label_col, sample, id_col, text_col)
    out = scored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
