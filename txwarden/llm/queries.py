"""Registered queries of the operators in this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txwarden.functions.staging import Staging, stage
from txwarden.llm.decontaminate import decontaminate
from txwarden.llm.jaccard_join import near_duplicate_components
from txwarden.llm.language_id import identify
from txwarden.llm.mixing import pareto_mix
from txwarden.llm.packing import cut_pieces, pack
from txwarden.llm.perspectives import rotate_perspectives
from txwarden.llm.prefix_trie import end_digests, ordered_turns, prefix_trie, with_shared_heads
from txwarden.llm.quality_classifier import quality_scores
from txwarden.llm.quality_rules import quality_verdicts
from txwarden.llm.spelling import corpus_words, variant_forms
from txwarden.llm.suffix_dedup import remove_repeats
from txwarden.llm.token_counts import prefix_token_counts
from txwarden.llm.warc import assemble, read_warc, resolve_revisits, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Limits and files that the registered queries use.
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
REPEAT_BYTES = 50
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 75
GOOD = 0.7
ITEM_WINDOW = 13
MIX_WEIGHTS, MIX_COPIES = (1, 2, 3), 3
FAMILY, HEADS = 100, 6
PACK_TOKENIZER, PACK_TOKENS, PACK_END = "byte_bpe_50k.json", 1024, 2
WORD_RUNS, WORD_CHARS, WORD_COUNT, WORD_NOISE, FORM_TIMES = "[A-Za-z\u00C0-\u00FF]+", 5, 3, 97, 2


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of whole texts; ``fit_chars`` is how much of a text the limit admits."""
    docs = table(spark, sf_dir, "documents")
    return prefix_token_counts(docs, TOKENIZER, TOKEN_LIMIT).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars"
    )


@query
def op1_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after repeats of earlier documents are removed."""
    return remove_repeats(table(spark, sf_dir, "documents"), length=REPEAT_BYTES).drop("spans")


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of documents that models are judged on and never learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query
def op2_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query
def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, then distance from the robust estimate of a document's language and source."""
    return quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered for each participant; masks as text, start-end in characters."""
    found = rotate_perspectives(table(spark, sf_dir, "conversations"))
    ranges = F.transform("mask", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string")))
    masked = F.aggregate("mask", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "conv_id",
        "perspective",
        "segment",
        F.size("messages").cast("long").alias("n_messages"),
        "text",
        F.array_join(ranges, ",").alias("mask"),
        masked.alias("n_masked"),
    )


@query
def op5_prefix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of Jaccard similarity 0.75 or more."""
    docs = table(spark, sf_dir, "documents")
    return near_duplicate_components(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


@query
def op6_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learned from labelled rows that are not held out."""
    docs, labels = (table(spark, sf_dir, x) for x in ("documents", "labels"))
    found = quality_scores(docs, labels, ~held_out("label_id"))
    good = (F.col("score") >= GOOD).cast("int")
    return found.select("doc_id", held_out().alias("held_out"), "score", good.alias("predicted"))


@query
def op8_benchmark_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    docs, items = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return decontaminate(docs, items, window=ITEM_WINDOW).drop("spans")


@query
def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document so that sources come near weights 1, 2, 3, repeating."""
    docs = table(spark, sf_dir, "documents")
    return pareto_mix(docs, weights=MIX_WEIGHTS, max_copies=MIX_COPIES).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op10_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives, read back and assembled, one row a capture."""
    pages = table(spark, sf_dir, "pages")
    path = f"{Staging(spark).path}/warc"
    write_warc(pages, path)
    records = stage(read_warc(spark, path, payload=False), "records")  # each archive is walked once
    captures = resolve_revisits(assemble(records))
    kind = pages.schema["page_id"].dataType
    revisit = F.col("type") == "revisit"
    return captures.select(
        F.col("page").cast(kind).alias("page_id"),
        F.when(revisit, F.col("origin_bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("origin_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("origin_page")).cast(kind).alias("refers_to"),
        F.size("requests").alias("n_requests"),
    )


def _crc32(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary"))


@query
def op11_sequence_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all conversations, each rebuilt on its family's first turns."""
    turns = ordered_turns(table(spark, sf_dir, "conversations"))
    rebuilt = with_shared_heads(turns, lambda c: c - c % FAMILY, lambda c: _crc32(c) % HEADS, HEADS - 1)
    trie = prefix_trie(rebuilt)
    nodes = trie.nodes.join(end_digests(trie.ends), ["depth", "key_a", "key_b"], "left")
    return nodes.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


@query
def op12_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the words one edit apart and the forms that these lead to."""
    docs = table(spark, sf_dir, "documents")
    words = corpus_words(docs, runs=WORD_RUNS, least_chars=WORD_CHARS, least_count=WORD_COUNT, drop_every=WORD_NOISE)
    return variant_forms(words, FORM_TIMES).select("word", "n", "n_near", "form", "form_n", "root")


@query
def op13_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the packed sequences, with a checksum of its ids."""
    pieces = cut_pieces(table(spark, sf_dir, "documents"), PACK_TOKENIZER, PACK_TOKENS, PACK_END)
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), PACK_TOKENS)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)
