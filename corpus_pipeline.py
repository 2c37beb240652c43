"""Corpus pipeline: from raw documents to packed training sequences, in five stages.

Each stage is one corpus operator over all that the stage before it kept. Between stages the
documents are written as Parquet to the shared folder and read again, so a lost executor costs
work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinmart.llm import decontaminate, packing, quality_rules
from kinmart.llm.files import modest_batches
from kinmart.llm.line_dedup import LineIndex
from kinmart.llm.near_dup import NearDup, near_duplicates
from kinmart.workspace import scratch, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
#: Row numbers that may be broadcast, some 16 bytes each.
MOST_SENT = 1 << 21


def with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the documents, their number of characters counted anew."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    modest_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_rules.fit(docs, labels)
    return quality_rules.judge(docs, model).where("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a document of smaller id holds."""
    modest_batches(spark)
    cleaned = LineIndex.build(docs).clean(docs)
    return with_text(cleaned.select("row.*", "text"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component: shingles of five words, similarity 0.8.

    It is the row of the least id, one without id only if no other is there. Rows are told
    apart by a number of their own, as ids may be missing or repeat. Texts stay where they are
    while the numbers of the rows to drop fit in a broadcast; more are joined by a shuffle.
    """
    modest_batches(spark)
    row = "near_dedup_row"
    while row in [c.lower() for c in docs.columns]:
        row += "_"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered")
    groups = near_duplicates(numbered, NearDup(words=5), doc_id=row)
    groups = groups.select(F.col("doc_id").alias(row), "component_id")
    ids = numbered.select(row, F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("bare"), "id", row)).alias("first")
    several = groups.join(ids, row).groupBy("component_id").agg(first, F.count(F.lit(1)).alias("n"))
    several = stage(several.where("n > 1").select("component_id", f"first.{row}"), "pipeline-first")
    several = several.withColumnRenamed(row, "stays")
    dropped = groups.join(several, "component_id").where(F.col(row) != F.col("stays"))
    dropped = stage(dropped.select(row), "pipeline-dropped")
    if dropped.count() <= MOST_SENT:
        dropped = dropped.hint("broadcast")
    return numbered.join(dropped, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within the error budget."""
    modest_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences, every source at its natural share of each window."""
    modest_batches(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), END_ID).drop("ids")


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Hashed n-grams, MinHash, edit distance and tokenizers are beyond SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        with scratch() as held:
            docs = held.keep(stage(apply(spark, docs, sf_dir), f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
