"""Registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinmart.llm import (
    decontaminate,
    files,
    lexical,
    license_scan,
    packing,
    pii,
    prefix_trie,
    quality_rules,
    token_counts,
    token_files,
    warc,
)
from kinmart.llm.line_dedup import LineIndex
from kinmart.llm.near_dup import NearDup, near_duplicates
from kinmart.llm.quotes import link_quotes

END_OF_DOCUMENT = 2
END_OF_PACKED = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near_dup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDup(words=2))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(
        docs,
        files.folder_for(docs, "token-ids"),
        tokenizer_path("word_bpe_49k.json"),
        END_OF_DOCUMENT,
    )
    return token_files.read_digests(manifest)


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.matches(docs, items)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cleaned = LineIndex.build(docs).clean(docs)
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def quoting(conversations: DataFrame) -> DataFrame:
    """The given conversations with quotes, of which they hold none: every second message first
    quotes an earlier one of its conversation, every fourth with another inside that quote."""
    originals = conversations.groupBy("conv_id", "turn").agg(F.max("text").alias("said"))
    rows = conversations
    for name, back in (("near", 1 + F.col("turn") % 3), ("far", F.lit(2))):
        earlier = originals.select(
            "conv_id", F.col("turn").alias("at"), F.col("said").alias(name)
        )
        rows = rows.withColumn("at", F.col("turn") - back).join(earlier, ["conv_id", "at"], "left")
        rows = rows.drop("at")
    marked = lambda c, mark: F.concat(
        F.lit(mark), F.replace(F.col(c), F.lit("\n"), F.concat(F.lit("\n"), F.lit(mark))), F.lit("\n")
    )
    none = F.lit("")
    inner = F.when(F.col("turn") % 4 == 3, F.coalesce(marked("far", "> > "), none)).otherwise(none)
    outer = F.when(F.col("turn") % 2 == 1, F.coalesce(marked("near", "> "), none)).otherwise(none)
    text = F.concat(inner, outer, F.coalesce("text", none))
    return rows.select("conv_id", "turn", "role", text.alias("text"))


def quotes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(quoting(table(spark, sf_dir, "conversations")))


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's target share goes with the square root of its tokens."""
    docs = table(spark, sf_dir, "documents")
    path = tokenizer_path("byte_bpe_50k.json")
    return packing.pack(docs, path, END_OF_PACKED, temperature=2.0).drop("ids")


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, files.folder_for(pages, "warc"))
    records = warc.read_archives(manifest)
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to")
    )


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    return found.select(F.col("row.doc_id").alias("doc_id"), *found.columns[1:])


def prefix_trie_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(lists))


def lexical_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.rank_documents(docs, items)


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_near_dup": near_dup_query,
    "op2_license_scan": license_query,
    "op3_token_files": token_files_query,
    "op4_quality_rules": quality_query,
    "op5_decontaminate": decontaminate_query,
    "op6_line_dedup": line_dedup_query,
    "op7_chat_quotes": quotes_query,
    "op8_packing": packing_query,
    "op9_warc": warc_query,
    "op10_pii": pii_query,
    "op11_prefix_trie": prefix_trie_query,
    "op12_lexical_search": lexical_query,
    "op13_token_counts": token_counts_query,
}
