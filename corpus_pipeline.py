"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents that its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.llm import decontaminate, language_id, line_dedup, near_dedup, packing
from assayflow.llm.common import broadcast_if_small, checkpointed, release, table, unused

#: Ids up to which a list of them is broadcast to the documents; beyond it the join shuffles.
MANY_IDS = 1_000_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents of undetermined language: null, empty and letterless texts, and all where no label is known.

    Nothing else is looked at: repeated rows, null ids and long texts are kept.
    """
    out = unused(docs, "language")
    found = language_id.predict(docs, language_id.fit(docs), out=out)
    return found.where(F.col(f"{out}.lang_pred") != language_id.UNDETERMINED).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut boilerplate lines, counted per source, out of the texts; n_chars follows.

    No row is dropped: null and empty texts, repeated rows and null sources come out as they are.
    """
    out = unused(docs, "lines")
    clean = line_dedup.drop_boilerplate(docs, F.col("source"), out=out).drop(out)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def _row_keys(docs: DataFrame, key: str, repeated: str) -> DataFrame:
    """``docs`` with an id for every row in ``key``, and in ``repeated`` whether its doc_id isn't its own alone.

    That id is the doc_id; for rows without one, and for further texts of a doc_id, a number made of id and text, so that
    only rows that are equal in both share it.  Ids and hashes are shuffled, not texts.
    """
    id_, first = unused(docs, "id_of"), unused(docs, "first_of")
    ids = docs.groupBy(F.col("doc_id").alias(id_)).agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("text")).alias(first))
    many = checkpointed(ids.where(F.col(id_).isNull() | (F.col("n") > 1)).select(id_, first))
    joined = docs.join(broadcast_if_small(many, many.count(), MANY_IDS), F.col("doc_id").eqNullSafe(F.col(id_)), "left")
    other = F.lit(near_dedup.SURROGATE) + F.xxhash64("doc_id", "text").bitwiseAND(F.lit(near_dedup.SURROGATE - 1))
    own = F.col(first).isNull() | (F.col("doc_id").isNotNull() & (F.xxhash64("text") == F.col(first)))
    return joined.withColumns({key: F.when(own, F.col("doc_id")).otherwise(other), repeated: F.col(first).isNotNull()}).drop(id_, first)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group, and one of rows that are equal in id and text.

    Every row is judged by itself: one without a doc_id, or with the doc_id of another text, takes part like any other and
    comes after those with an id of their own.  Texts without words link with nothing and stay.
    """
    key, repeated = unused(docs, "row_key"), unused(docs, "is_repeated")
    keyed = _row_keys(docs, key, repeated)
    found = near_dedup.near_duplicates(keyed.select(F.col(key).cast("bigint").alias("doc_id"), "text"))
    gone = checkpointed(found.where("not kept").select(F.col("doc_id").alias(key)).distinct())
    left = keyed.join(broadcast_if_small(gone, gone.count(), MANY_IDS), key, "left_anti")
    once = left.where(F.col(repeated)).dropDuplicates([key])
    return left.where(~F.col(repeated)).unionByName(once).select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove rows whose text contains a benchmark item; null, empty and repeated texts, null ids and an empty benchmark need no care."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 1024 tokens; one row per piece.

    A null text is an empty one, of one piece; rows are packed as often as they occur; columns other than doc_id and text are left.
    """
    import public_tokenizers

    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]
#: SQL can't express the fitted classifier and the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's output is kept until the next one's is there."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
        release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
