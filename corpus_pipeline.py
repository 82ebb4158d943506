"""The corpus pipeline: five stages, each written as Parquet and read again as the next
stage's documents. All stages but the last return the columns of ``documents``.

1. quality rules: failing lines go, and documents that the rules reject;
2. toxicity: documents that the classifier calls toxic go;
3. near duplicates: the smallest document of each group stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. SentencePiece: ids, spans in the original text, and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import decontamination, near_dedup, quality_rules, sentencepiece_codec, toxicity
from encore.llm.common import checkpointed, fresh, id_bucket, table
from encore.llm.queries import tokenizer_path
from encore.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of the source table that op4 learns from, too."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), lambda: id_bucket(5) != 0)
    name = fresh(docs, "_text")
    scored = toxicity.score_documents(docs.withColumn(name, F.col("text")), model, text=name)
    return scored.where(F.col("score") < 0.5).select(*docs.columns)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words are in no group and stay; so do documents without id."""
    gone = checkpointed(near_dedup.group(docs).where(~F.col("kept")).select("doc_id").distinct())
    # Of repeated rows of one document one stays. Only ids that occur again (and rows without
    # id) are compared whole; the others' texts are not shuffled for it.
    again = checkpointed(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"))
    known = docs.where("doc_id is not null")
    once = known.join(gone.union(again), "doc_id", "left_anti").select(*docs.columns)
    more = known.join(again.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    return once.union(more.union(docs.where("doc_id is null")).dropDuplicates())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxic),
    ("MinHash near-dedup", duplicates),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding and decoding", pieces),
]

#: The classifier and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
