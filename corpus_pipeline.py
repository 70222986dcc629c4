"""Five stages over the documents: each works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode_texts
from tidemark.llm.common import written
from tidemark.llm.fm_index import find_phrases
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.simhash import near_copies
from tidemark.llm.toxicity import score_texts, train

RADIUS, SHINGLE_WORDS, PHRASE_WORDS = 4, 4, 10


def _apart(docs: DataFrame, f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of docs as f leaves them, n_chars counted anew; f sees only doc_id and text under their names, so its own columns clash with none."""
    inner = [c if c in ("doc_id", "text") else f"_{k}" for k, c in enumerate(docs.columns)]
    found = f(docs.toDF(*inner))
    kept = [F.col(i).alias(c) for i, c in zip(inner, docs.columns)]
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        kept[at] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return found.select(*kept)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; all others stay as they are.

    Null and empty texts score without evidence and stay; very long texts are scored whole; repeated rows
    score alike and go or stay alike; null ids stay or go by their text; a score of exactly 0.5 is
    rejected; without documents or labels nothing goes; columns of docs keep their values whatever their names.
    """
    model = train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _apart(docs, lambda d: score_texts(d, model, keep_columns=True).where("predicted = 0"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals or nearly equals go; documents stay, if need be with an empty text.

    Null and empty texts stay; very long texts and lines are read whole; of equal lines the first by id and
    number stays; rows without an id stay untouched; of repeated ids, lines at the same place are one line;
    an empty table stays empty; other columns keep their values whatever their names.
    """
    return _apart(docs, dedup_lines)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays.

    Null and empty texts are copies of one another; very long texts are read whole; rows without an id
    stay; rows of one id go or stay together: they go if one of them has a near copy with a lesser id, so
    repeated rows of the least id all stay; an empty table stays empty; other columns keep their values.
    """
    found = near_copies(docs.select("doc_id", "text"), RADIUS, SHINGLE_WORDS)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out of the texts; all documents stay.

    Null and empty texts stay as they are, as do texts without a passage; very long texts are searched
    whole; repeated rows and null ids are cut each on its own; overlapping passages are cut as one; no
    items or documents, no cuts; other columns keep their values whatever their names.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _apart(docs, lambda d: find_phrases(d, benchmark, PHRASE_WORDS, cut=True))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token counts and digests, one row a document; nulls, long texts, repeated rows, names and empty tables as encode_texts says."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash), ("decontamination", decontamination), ("bpe", bpe)]
#: A trained classifier, 64-bit XXH64 fingerprints and BPE have no SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
