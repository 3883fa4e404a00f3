"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, token ids.

Each stage takes the documents that the one before has kept, through one operator of ``lodestar.llm``, and
its decisions take effect: documents go, or words are cut. All but the last return the columns of
``documents``; between stages the rows are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import bpe, decontam, simhash, substring, toxicity
from lodestar.llm.sample import held_out
from lodestar.llm.store import drop_stored, scope, stored
from lodestar.session import ship_package
from lodestar.sources.tables import read_table

#: Toxicity score from which a document goes.
TOXIC = 0.5
#: Size of the tokenizer's tables beside what the stages before have left in an executor.
BPE_SHARE = 0.25


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under ``TOXIC``."""
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels")
    machine = toxicity.fit_machine(docs, labels, "toxic", ~held_out("doc_id", 5, 0))
    return toxicity.score(docs, machine).where(F.col("score") < TOXIC).select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id."""
    ship_package(spark)
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words and more that an earlier one has.

    Where words go, the text is the kept words joined by one space and ``n_chars`` its length; a document may
    end up empty. All other documents are as they were.
    """
    ship_package(spark)
    cut = substring.cut_repeats(docs)
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(changed, F.length("kept_text")).otherwise(F.col("row.n_chars")).cast("long"),
    }
    return cut.select(*(new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship_package(spark)
    items = read_table(spark, sf_dir, "benchmark")
    found, _ = decontam.passage_matches(docs, items)
    return found.where(F.size("matches") == 0).select("row.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    ship_package(spark)
    found = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True, share=BPE_SHARE)
    return found.select("row.doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: No stage but the last can be put in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``. What a stage has written for itself, and its input, go when its result is whole."""
    docs, first = read_table(spark, sf_dir, "documents"), True
    for name, stage in STAGES:
        with scope(spark) as keep:
            made = keep(stored(stage(spark, docs, sf_dir), name))
        if not first:
            drop_stored(docs)
        docs, first = made, False
    return docs
