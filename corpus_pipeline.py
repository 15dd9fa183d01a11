"""A corpus pipeline of five operators; each stage is written and read again before the next one.

Defined cases, in the order of the stages: null texts and texts without letters are dropped as of no known language; of
near copies the smallest doc_id stays, a null one only if there is no other, and of rows equal in doc_id and text one;
texts without words are no copies and hit nothing; mixing draws equal ids alike and takes null as a margin value of its
own; token files order rows of one doc_id by checksum and length. Very long texts pass every stage whole. Columns beside
doc_id, text, lang and source pass through the stages; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chosen, decon, langid, mix, rans, scratch

#: A text is kept if at least this share of its n-grams, less what chance explains, is of one language.
LEAST_SCORE = 0.1


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus; texts without letters and gibberish go."""
    scratch.prepare(spark)
    judged = langid.predict(docs, langid.learn(docs), pred="__lang", score="__score")
    return judged.where((F.col("__lang") != "und") & (F.col("__score") >= LEAST_SCORE)).drop("__lang", "__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    scratch.prepare(spark)
    return chosen.deduplicated(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decon.clean(docs, scratch.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come closer to even."""
    scratch.prepare(spark)
    return mix.sample(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from the token files."""
    scratch.prepare(spark)
    return rans.report(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language ID", known_language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_free),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_files),
]

#: Languages are learned, near copies are transitive and ids come from a tokenizer: not in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from what its predecessor wrote."""
    docs = scratch.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
