"""One query for each operator, over whole tables and with production parameters."""

import functools
import tempfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import (
    backoff_lm,
    conversation_trie,
    embedding_e8,
    isolation_rules,
    lemp_search,
    license_rules,
    packing,
    pii_anchors,
    quality_nbsvm,
    sentencepiece_prefix,
    simhash_golay,
    substring_debruijn,
    token_store,
)
from martwright.llm.common import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


# Removed when Python exits.
_folders: list[tempfile.TemporaryDirectory] = []


def work_locally(spark: SparkSession) -> None:
    """A temporary checkpoint folder for a local session that names none."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.startswith("local"):
        folder = tempfile.TemporaryDirectory(prefix="llm-")
        _folders.append(folder)
        context.setCheckpointDir(folder.name)


def in_folder(run):
    """Look after the folder before a function whose first argument is the session."""

    @functools.wraps(run)
    def prepared(spark: SparkSession, *arguments) -> DataFrame:
        work_locally(spark)
        return run(spark, *arguments)

    return prepared


def query(run):
    QUERIES[run.__name__] = in_folder(run)
    return QUERIES[run.__name__]


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_license_rules(spark, sf_dir):
    scanned = license_rules.scan(table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id",
        "n_sentences",
        F.size("known").alias("n_known"),
        F.array_join("licences", ",").alias("licences"),
    )


@query
def op2_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op3_quality_nbsvm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        quality_nbsvm.is_held_out().alias("held_out"),
        quality_nbsvm.score_column(model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op4_substring_debruijn(spark, sf_dir):
    cleaned = substring_debruijn.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return cleaned.select(
        "doc_id",
        "result.n_words",
        "result.n_removed",
        F.sha2("result.kept", 256).alias("kept_sha256"),
    )


@query
def op5_embedding_e8(spark, sf_dir):
    found = embedding_e8.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.98)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


@query
def op6_backoff_lm(spark, sf_dir):
    scored = backoff_lm.score(table(spark, sf_dir, "documents"), order=3)
    mean = F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6))
    return scored.select("doc_id", "n_words", "n_full", "n_unseen", mean.alias("mean_log_score"))


@query
def op7_isolation_rules(spark, sf_dir):
    stats = isolation_rules.measured(table(spark, sf_dir, "documents"))
    rules = isolation_rules.fit(stats, table(spark, sf_dir, "labels"))
    judged = isolation_rules.judge(stats, rules)
    return judged.select("doc_id", *isolation_rules.BASE, "base_failed", "kept", "anomaly")


@query
def op8_simhash_golay(spark, sf_dir):
    found = simhash_golay.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    fingerprint = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


@query
def op9_token_store(spark, sf_dir):
    folder = new_folder(spark, "ids")
    token_store.write(table(spark, sf_dir, "documents"), WORD_BPE, folder, end_id=2)
    return token_store.read(spark, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query
def op10_sentencepiece_prefix(spark, sf_dir):
    trip = sentencepiece_prefix.round_trip(table(spark, sf_dir, "documents"), PIECE_BPE)
    return trip.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_pii_anchors(spark, sf_dir):
    found = pii_anchors.find(table(spark, sf_dir, "documents"))
    base = pii_anchors.of_kinds(F.col("spans"), *pii_anchors.BASE_KINDS)
    counts = [
        F.size(pii_anchors.of_kinds(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
        for kind in pii_anchors.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii_anchors.joined(base), 256).alias("base_sha256"),
        pii_anchors.joined(F.col("spans")).alias("spans"),
    )


@query
def op11_lemp_search(spark, sf_dir):
    return lemp_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_conversation_trie(spark, sf_dir):
    turns = conversation_trie.numbered(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(*conversation_trie.with_openings(turns))
