"""A training corpus from raw documents: five stages, each one operator over all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import stored, table
from tideline.llm.jaccard_join import ngram_jaccard_join
from tideline.llm.mixing import mixed_rows
from tideline.llm.packing import pack
from tideline.llm.quality import fit, scored
from tideline.llm.queries import tokenizer_path
from tideline.llm.suffix_dedup import without_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that nearest labelled neighbours vote to be of quality.

    Rows are judged by their texts alone: repeated rows, null ids and rows with equal ids all stay or go by themselves. A
    null or empty text has the score of the labels' prior. A score of exactly 0.5 keeps its document. An empty table gives
    an empty one; columns of any name go along.
    """
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    score = "_score" + "_" * max(map(len, docs.columns))
    return scored(docs, model, score_col=score).where(f"{score} >= 0.5").select(*(F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group that 5-word shingles link at a Jaccard similarity of 0.8.

    Texts without words, null texts among them, are in no group and all stay. Rows count one by one: where ids are null or
    come more than once, rows are numbered in the order of id (null last) and a hash of the text, so that a row goes
    only if a text like its own stays. Of equal rows one stays. An empty table gives an empty one; columns of any name go
    along.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 or doc_id is null").isEmpty():
        kept = ngram_jaccard_join(docs, n=5, num=80, den=100).where("doc_id = component_id").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    spread = docs.select(F.struct("*").alias("d"), F.xxhash64("text").alias("h")).repartitionByRange(F.col("d.doc_id").asc_nulls_last(), "h").sortWithinPartitions(F.col("d.doc_id").asc_nulls_last(), "h")
    numbered = stored(spread.select("d", F.monotonically_increasing_id().alias("row")), "numbered")
    kept = ngram_jaccard_join(numbered.select("row", "d.text"), n=5, num=80, den=100, id_col="row").where("doc_id = component_id").select(F.col("doc_id").alias("row"))
    return numbered.join(kept, "row", "left_semi").select("d.*")


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the byte strings of 200 and more that come more than once.

    A document that loses all of its text goes; null and empty texts stay, as empty ones. Equal texts of 200 bytes and
    more lose each other; ids play no part. A character that is cut goes as a whole. An empty table gives an empty one;
    columns of any name go along.
    """
    return without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them.

    Null texts and those without words are taken by no mix and go. A null source is one of its own. Rows with equal or null
    ids count each for itself. An empty table gives an empty one; columns of any name go along.
    """
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 2048 tokens.

    Every row is packed, repeated ones as often as they come and null ids too; a null or empty text is one piece of one
    token. An empty table gives an empty one; other columns are left behind.
    """
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: None of nearest neighbours, components of links and best-fit packing has a SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
