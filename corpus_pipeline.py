"""From raw documents to packed training sequences, each stage by one operator.

Quality classifier and quality rules drop what they reject, one document of each
near-duplicate group stays, repeated passages are cut out of texts, and what is left is
packed. A stage gets what the one before has kept, read from Parquet in the shared folder,
so a lost executor costs a repeated task and never an earlier stage.

Defined cases: null and empty texts go with the quality rules (too few words); a row
without a doc_id is judged like any other but never a near-duplicate; rows that repeat an id
are documents of their own until near-duplicates leave one of those that are alike; further
columns are carried up to packing, whatever their names; an empty table gives no pieces.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import (
    isolation_rules,
    packing,
    quality_nbsvm,
    simhash_golay,
    substring_debruijn,
)
from martwright.llm.common import stored
from martwright.llm.queries import in_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@in_folder
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 at least."""
    return quality_nbsvm.keep_good(docs, quality_nbsvm.fit(docs, _labels(spark, sf_dir)))


@in_folder
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor stand out in the forest."""
    stats = isolation_rules.measured(docs)
    return isolation_rules.keep_usual(docs, isolation_rules.fit(stats, _labels(spark, sf_dir)))


@in_folder
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    return simhash_golay.keep_first(docs, shingle=3, max_bits=3)


@in_folder
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that lie elsewhere too, each copy of
    a passage being taken out; other documents keep their text as it is. A document that was
    nothing but such passages stays with an empty text."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    cleaned = substring_debruijn.remove_repeats(rows, window=35, carry=("row",))
    kept = F.col("result.kept")
    new = {"text": kept, "n_chars": F.char_length(kept).cast("long")}
    changed = F.col("result.n_removed") > 0
    old = {c: F.col("row").getField(c) for c in docs.columns}
    return cleaned.select(
        *(F.when(changed, new[c]).otherwise(v).alias(c) if c in new else v.alias(c) for c, v in old.items())
    )


@in_folder
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of up to 2048 ids."""
    return packing.pack(docs, TOKENIZER, end_id=1)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", packed),
]

# The classifier, the forest and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


@in_folder
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
