"""From raw documents to packed training sequences, stage by stage.

Each stage works on all rows that its predecessor kept, written as Parquet and
read again in between. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import near_dup, packing, quality, substrings
from starloom.llm.common import col, materialize, ship
from starloom.sources.driver import read_table

TOKENIZER = "byte_bpe_50k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score of at least
    ``quality.THRESHOLD``); it learns from the labels that are not held out.
    Null texts are scored as empty ones, every repeated row by itself; an empty
    table stays empty."""
    ship(spark)
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.where(F.col(scored.columns[-1]) >= quality.THRESHOLD).select(
        *(col(scored, c).alias(c) for c in docs.columns))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles,
    similarity of at least 0.8), the one with the smallest doc_id. Texts
    without words, null ones too, are no duplicates of each other; of rows with
    equal doc_id and text one stays; an empty table stays empty."""
    ship(spark)
    return near_dup.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 13-word windows of documents with smaller doc_ids.
    Texts that repeat nothing stay as they are (null ones turn empty);
    n_chars follows a text that changes. Rows of one doc_id are no earlier
    documents of each other; an empty table stays empty."""
    ship(spark)
    kept = substrings.remove_repeats(docs, keep=[c for c in docs.columns if c != "text"], tidy=False)
    spans, text = (col(kept, c) for c in kept.columns[-2:])
    now = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        now["n_chars"] = F.when(F.size(spans) > 0, F.char_length(text).cast(kind)).otherwise(kept["n_chars"])
    return kept.select(*((now[c] if c in now else col(kept, c)).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 1024 tokens. A
    null text is an empty one (its end token alone), repeated rows are packed each;
    an empty table has no pieces."""
    ship(spark)
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(pieces, docs.count()).withColumnRenamed("key", "doc_id")


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage), ("substring", substring_stage), ("packing", packing_stage)]

# The classifier, the tokenizer and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
