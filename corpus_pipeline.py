"""Corpus pipeline: quality filter, near-dedup, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns the columns of
documents, the last one the pieces of packed sequences. ``run`` writes every stage and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import queries
from shelfcast.llm.frames import Staged, same_row, table, text_marks
from shelfcast.llm.mixing import Mixture
from shelfcast.llm.near_dedup import verdicts
from shelfcast.llm.packing import packed
from shelfcast.llm.quality import quality_scores

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")
#: A model and components of trained and iterated numbers, drawn block orders, and token ids.
ORACLE_SQL = None


def _where(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` equal to one of ``kept`` (doc_id, h0, h1, ...) in key and text, with its columns."""
    kept = kept.withColumnRenamed("doc_id", "_id").distinct()
    marked = docs.select(*DOCUMENTS, *(m.alias(f"_{i}") for i, m in enumerate(text_marks())))
    own, its = ("doc_id", "_0", "_1"), ("_id", "h0", "h1")
    return marked.join(kept, same_row(*([F.col(c) for c in names] for names in (own, its))))


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least the accepted one."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"), marked=True)
    return _where(docs, scores.where(f"score >= {queries.ACCEPTED}").select("doc_id", "h0", "h1")).select(*DOCUMENTS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id. Texts that share an id, or have
    none, go by their own groups. A row without words goes only if it repeats one in id and text."""
    kept = _where(docs, verdicts(docs).where("chosen").select("doc_id", "h0", "h1", "n"))
    alone = F.col("doc_id").isNull() & (F.col("n") == 0)
    once = kept.where(~alone).dropDuplicates(["doc_id", "h0", "h1"])
    return once.union(kept.where(alone)).select(*DOCUMENTS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every copy of a document in the mix, with the words of that copy that are taken;
    documents of which nothing is taken go."""
    copies = Mixture(docs, carried=DOCUMENTS).texts()
    return copies.select(
        "own.doc_id", "text", "own.lang", "own.source", F.length("text").cast("long").alias("n_chars")
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences."""
    return packed(docs, queries.tokenizer_path(), queries.SEQUENCE)


STAGES = [
    ("quality classifier", accept_quality),
    ("near-dedup", drop_near_duplicates),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).rows
    return STAGES[-1][1](spark, docs, sf_dir)
