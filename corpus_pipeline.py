"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept;
`run` writes its result as Parquet and reads it again for the next. All stages but the
last return the columns of `documents` alone; `n_chars` follows the text where a stage
changes it.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import language_id, mixing, near_dedup, packing, substring_dedup
from riskflow.sources.tables import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
REPEATED_WORDS = 50
SEQUENCE_TOKENS = 4096
TOKENIZER = "word_bpe_49k.json"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones explain.

    Texts without a letter go, and those that no language's automaton parses into phrases
    cheaper than letters: random strings and scripts without labelled text. Short texts
    stay, and so do all with letters where no language could be learned.
    """
    judged = language_id.identify(docs.select(*COLUMNS), known_col="known")
    return judged.filter("known").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    What is dropped is kept as a table of ids. Spark sees its size, and joins it to the
    texts without a shuffle if it is small.
    """
    docs = docs.select(*COLUMNS)
    judged = near_dedup.near_duplicates(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    dropped = stored(judged.filter(~F.col("kept")).select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document; emptied documents go."""
    cut = substring_dedup.remove_repeats(docs.select(*COLUMNS), window=REPEATED_WORDS)
    cut = cut.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("kept_text"))
    return cut.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", chars.cast("bigint").alias("n_chars")
    )


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source cut to its share."""
    docs = docs.select(*COLUMNS)
    drawn = mixing.mixed_documents(docs.withColumn("__chars", F.length("text")))
    same = F.length("text").eqNullSafe(F.col("__chars"))
    chars = F.when(same, F.col("n_chars")).otherwise(F.length("text")).cast("bigint")
    return drawn.withColumn("n_chars", chars).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences; a document that the mix repeats is packed each time."""
    return packing.packed_documents(
        docs.select(*COLUMNS), public_tokenizers.path(TOKENIZER), SEQUENCE_TOKENS
    )


def _in_small_batches(stage):
    """`stage`, whose whole texts go to Python workers BATCH_ROWS at a time.

    Spark reads the setting when the stage's result is written, so the session keeps it.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _in_small_batches(known_language)),
    ("near_dedup", _in_small_batches(one_of_each_group)),
    ("substring_dedup", _in_small_batches(without_repeated_passages)),
    ("mixing", _in_small_batches(mixed)),
    ("packing", _in_small_batches(packed)),
]

#: SQL has no suffix automata, MinHash components or tokenizer: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(BATCH_SETTING)
    try:
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs
