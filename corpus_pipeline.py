"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, SentencePiece."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalwatch.llm import lines, mixing, pieces, quality, simhash
from vitalwatch.llm.scratch import stored


def quality_stage(spark, docs, sf_dir):
    """Documents that the rules reject go; repeated lines count by their words, as the line stage comes later."""
    return quality.kept_documents(docs)


def line_stage(spark, docs, sf_dir):
    """Boilerplate lines of any length go; documents stay."""
    d = lines.line_dedup(docs)
    return d.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def simhash_stage(spark, docs, sf_dir):
    """One row of each near-duplicate group stays, the one of the smallest id; rows without an id come
    last. Rows are told apart by id and text, so repeated ids replace each other within a group only."""
    return simhash.one_of_each(docs)


def mixing_stage(spark, docs, sf_dir):
    """The mix by target weights: repeats are rows, parts of documents are the words that the mix takes."""
    return mixing.mixed_documents(docs)


def pieces_stage(spark, docs, sf_dir):
    """Piece ids of every document (the last stage)."""
    import public_tokenizers

    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("simhash near-dedup", simhash_stage),
          ("mixing sources", mixing_stage), ("sentencepiece", pieces_stage)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
