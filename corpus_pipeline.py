"""The corpus pipeline: language, exact and near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stages before it kept.
All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.blocks import NO_ID
from headway.llm.exact_dedup import exact_dedup, normalised
from headway.llm.jaccard_join import jaccard_join
from headway.llm.language_id import keep_identified, train
from headway.llm.packing import best_fit_packing
from headway.llm.shared import stored, table
from headway.llm.substring_dedup import substring_dedup


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or with a null text, or in which no language stands out, go.

    Long texts are read whole; repeated rows are judged alike. Without a row that has text and lang
    nothing can be learned, and no row stays.
    """
    return keep_identified(docs, train(docs))


def _wrapped(docs: DataFrame) -> DataFrame:
    """docs as one column, doc, beside which a stage's own columns clash with nothing."""
    return docs.select(F.struct("*").alias("doc"))


def _with_own_ids(docs: DataFrame) -> DataFrame:
    """(doc, own_id); own_id, which no two rows share: doc_id, or the place by doc_id if some ids repeat; null is last."""
    rows = _wrapped(docs)
    own = F.col("doc.doc_id")
    if rows.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("many")).filter("many > 1").isEmpty():
        return rows.select("doc", own.alias("own_id"))
    # By text as well, so that the rows of one id, or of none, spread.
    order = [own.asc_nulls_last(), F.xxhash64("doc.text")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.select("doc", F.monotonically_increasing_id().alias("own_id")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the smallest doc_id stays, and one only; ids may repeat.

    A null text equals an empty one. A null doc_id counts as the largest. An empty table stays empty.
    """
    kept = exact_dedup(docs).filter("kept").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("own_id"), F.unhex("text_sha256").alias("own_digest")
    ).distinct()
    digest = F.unhex(F.sha2(normalised(F.col("doc.text")), 256))
    rows = _wrapped(docs).select("doc", F.coalesce("doc.doc_id", F.lit(NO_ID)).alias("own_id"), digest.alias("own_digest"))
    # The number first: of a text and id that many rows share, each task sends one row.
    once = Window.partitionBy("own_id", "own_digest").orderBy("doc.text")
    first = rows.withColumn("own_number", F.row_number().over(once)).filter("own_number = 1")
    return first.join(kept, ["own_id", "own_digest"], "left_semi").select("doc.*")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by near-duplicate links the one with the smallest id stays.

    Texts that are null or without words are near nothing and stay; rows without an id are documents
    of their own. An empty table stays empty.
    """
    rows = _with_own_ids(docs)
    found = jaccard_join(rows.select(F.col("own_id").alias("doc_id"), F.col("doc.text").alias("text")))
    kept = found.filter(F.col("component_id").eqNullSafe(F.col("doc_id"))).select(F.col("doc_id").alias("kept_id")).distinct()
    return rows.join(kept, F.col("own_id").eqNullSafe(F.col("kept_id")), "left_semi").select("doc.*")


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go out of the texts; n_chars follows.

    Every row stays; a null text becomes an empty one. Of rows without an id each is a document, after
    those with one. An empty table stays empty.
    """
    rows = _with_own_ids(docs)
    found = substring_dedup(rows.select(F.col("own_id").alias("doc_id"), F.col("doc.text").alias("text"))).select(
        F.col("doc_id").alias("cut_id"), F.col("kept_text").alias("cut_text")
    )
    cut = F.col("doc").withField("text", F.col("cut_text"))
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.length("cut_text").cast(docs.schema["n_chars"].dataType))
    return rows.join(found, F.col("own_id").eqNullSafe(F.col("cut_id"))).select(cut.alias("doc")).select("doc.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document, or each piece of a long one, stands in a training sequence.

    Null and empty texts have a row of length 0 without a bin; an empty table gives no row.
    """
    return best_fit_packing(docs)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("substring dedup", passage_stage),
    ("best-fit packing", packing_stage),
]

# Language ID is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
