"""A training-text pipeline over ``documents``.

Each stage works on all that the one before it kept, as it was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillet.llm import lines, mixing, packing, quality, simhash
from rillet.llm.common import DOC_COLUMNS, drop_written, prepare, table, written
from rillet.llm.encode import default_tokenizer
from rillet.llm.queries import MAX_BITS, MIX_SEED, PACK_END, SEQUENCE, SHINGLE_WORDS, WINDOW_WORDS


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model rejects go."""
    prepare(spark)
    docs = docs.select(*DOC_COLUMNS)
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"), quality.MOST_ROWS)
    return docs.filter(quality.score_column(model)("text") >= quality.THRESHOLD)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines, and runs of lines with 50 words, that an earlier document has go,
    and documents that lose all lines."""
    prepare(spark)
    return lines.rewritten(docs.select(*DOC_COLUMNS), words=WINDOW_WORDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest doc_id."""
    prepare(spark)
    return simhash.one_of_each(docs.select(*DOC_COLUMNS), SHINGLE_WORDS, MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights: documents are repeated or left out."""
    prepare(spark)
    return mixing.mix(docs.select(*DOC_COLUMNS), mixing.WEIGHTS, mixing.MOST, MIX_SEED)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids, neighbours by content together."""
    prepare(spark)
    return packing.pack(docs.select(*DOC_COLUMNS), default_tokenizer(), PACK_END, SEQUENCE)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Learned scores, token ids and hash fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again, and the
    one before it removed."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        made = written(stage(spark, docs, sf_dir), name)
        if i:
            drop_written(docs)
        docs = made
    return docs
