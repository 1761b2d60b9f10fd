"""The corpus pipeline: stages over the documents, each written and read again.

1. language: documents without a recognisable language go (no letter, or a best language
   below LEAST_SCORE).
2. near_duplicates: of each group of documents linked by shared n-grams, the one with the
   smallest id stays; documents without an id, or without words, stay.
3. repeated_passages: passages of PASSAGE words that start more than once go, all copies
   of them; a document of which nothing but blanks is left goes too.
4. secrets: found secrets are replaced by a mark.
5. packing: what is left, packed into sequences of tokens.

Every stage but the last returns the columns of its input. Nulls, empty and repeated rows,
and empty tables are treated as the operators say; an empty text is no recognisable
language and goes in stage 1. Extra columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worksledger.llm import jaccard, langid, packing, secrets, suffixes
from worksledger.llm.common import landed, table

LEAST_SCORE = 0.4
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
PASSAGE = 51  # words
SEQUENCE = 2048


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = langid.fit(docs, "text", "lang", F.xxhash64("doc_id"))
    if net is None:  # nothing to learn from: only documents without a letter are known to go
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    return docs.where(langid.recognised(F.col("text"), net, LEAST_SCORE).isNotNull())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard.join(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    gone = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    # rows that repeat an id are one document: one of equal rows stays
    kept = named.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).union(docs.where(F.col("doc_id").isNull()))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffixes.dedup(docs, PASSAGE, keep_columns=True, words=True)
    cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.where(F.coalesce(F.regexp_like("text", F.lit(r"\S")), F.lit(False))).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, size=SEQUENCE, ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Language ID, suffix arrays and packing have no statement in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
