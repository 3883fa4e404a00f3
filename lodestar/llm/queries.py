"""Registered queries of the corpus operators: thin callers that derive the contracted columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import align, bpe, chat, decontam, licenses, mtree, negatives, quality, rules, simhash, substring, tokenfile, toxicity
from lodestar.llm.sample import held_out
from lodestar.llm.store import shared_path, stored
from lodestar.sources.tables import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document once passages of 50 words that an earlier one has are cut."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return substring.cut_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


@_query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document written to seekable files and read back."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    folder = shared_path(spark, "token-ids")
    index = tokenfile.write_ids(docs, folder, _vocabulary("word_bpe_49k.json"))
    return tokenfile.read_ids(index, folder, with_ids=False).select("row.doc_id", "row.start", "row.n_tokens", "ids_crc32")


@_query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited: one row for each document and item found."""
    docs, items = read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    found, having = decontam.passage_matches(docs, items)
    found = decontam.item_matches(found, having, "doc_id")
    members = stored(decontam.equal_items(items), "members")
    return found.join(members, "item_id").select("doc_id", F.col("member_id").alias("item_id"), "score", "end_word")


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in every document, by canonical digest."""
    return licenses.license_hits(read_table(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _scored(scored: DataFrame, out: Column, least: float) -> DataFrame:
    return scored.select("row.doc_id", out.alias("held_out"), "score", F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))


@_query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-chain quality score of every document; a quarter of the ids never trains."""
    docs, labels = read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "labels")
    field = quality.fit_field(docs, labels, "quality", ~held_out("doc_id", 4, 2))
    return _scored(quality.score(docs, field), held_out("row.doc_id", 4, 2), 0.7)


@_query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes control strings, written as examples and read back."""
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(odd)
    return chat.conversation_digests(stored(chat.prefix_target_examples(turns), "examples"))


@_query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to, as digests."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = bpe.encode(docs, _vocabulary("byte_bpe_50k.tiktoken"), _pattern(), digests=True, with_ids=False)
    return found.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers over every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    found = rules.quality_rules(docs).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factorization-machine toxicity score of every document; a fifth of the ids never trains."""
    docs, labels = read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "labels")
    machine = toxicity.fit_machine(docs, labels, "toxic", ~held_out("doc_id", 5, 0))
    return _scored(toxicity.score(docs, machine), held_out("row.doc_id", 5, 0), 0.5)


@_query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = simhash.simhash_components(docs)
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of highest inner product for every fiftieth id, against all rows."""
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return mtree.top_k(mtree.build_index(rows), rows.where("vec_id % 50 = 0"), 5)


@_query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens that two tokenizers make of every document."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = align.token_alignment(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))
    return found.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score from half to 95 % of an anchor's positives, for every fiftieth id."""
    rows = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.candidate_blocks(rows, label, F.col("vec_id") % 50 == 0))
