"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes every stage's result as Parquet
in the shared checkpoint folder and hands it, read again, to the next one, so a
lost executor costs no more than the running stage; files of a stage are removed
when the next one's are complete.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_duplicates``: of the rows that near copies link, the one with the
   smallest id stays (null last). Near copies share 80 % of their five-word shingles.
3. ``private_data``: personal data get surrogates.
4. ``mixing``: sources are taken to their target weights, some documents twice.
5. ``packing``: one row a piece of a document and its place in a sequence.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastmile.llm import jaccard_join, mixing, packing, pii, quality
from lastmile.llm.common import ready, scratch, shared_folder, table

#: SQL cannot express the classifier, the join and the packing; the tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None
#: Words of a shingle, and the similarity (a fraction) that makes two documents near copies.
SHINGLE, SIMILARITY = 5, (80, 100)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of at least ``quality.KEEP_FROM``."""
    scored = quality.score_quality(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.where(F.col("score") >= quality.KEEP_FROM).select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id.

    Null ids come last, ties fall to the smallest hash of the text, then of the
    row. Documents without words stay. Where ids are null or shared, rows are
    written once with numbers of their own, and the join links those."""
    ids = docs.groupBy("doc_id").count()
    if ids.where("count > 1 or doc_id is null").isEmpty():
        groups = jaccard_join.jaccard_components(docs, SHINGLE, *SIMILARITY)
        gone = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__gone")).distinct()
        return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    path = scratch(spark, "rows")
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    groups = jaccard_join.jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text"), SHINGLE, *SIMILARITY)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.xxhash64(F.to_json(F.struct(*docs.columns))), F.col("__row"))
    named = groups.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", order.alias("order")), "__row")
    stays = named.groupBy("component_id").agg(F.min("order")["__row"].alias("__row")).select("__row")
    return rows.join(stays, "__row", "left_semi").select(*docs.columns)


def private_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced."""
    return pii.pseudonymise(docs).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each time that a document is taken."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mixed documents and its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality", ready(quality_stage)),
    ("near_duplicates", ready(near_duplicates_stage)),
    ("private_data", ready(private_data_stage)),
    ("mixing", ready(mixing_stage)),
    ("packing", ready(packing_stage)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # a stage's result goes once the next one's is written
            done = spark._jvm.org.apache.hadoop.fs.Path(before)
            done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
        before = path
    return docs
