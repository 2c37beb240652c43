"""First row per key, latest row per key, and top matches with boundary tie flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmart.schemas import SCORE, TIE_FLAG


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``.

    The limit on row_number lets Spark keep one row per key and task before the shuffle, so
    a key that holds most of the rows still sends one row per task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], *recency: str) -> DataFrame:
    """One row per key, the one with the highest ``recency`` columns, compared in turn."""
    return first_per_key(df, keys, *[F.col(name).desc() for name in recency])


def best_scores(scored: DataFrame, n: int, fan_in: int = 1) -> DataFrame:
    """The ``n`` highest scored targets of every source, ranked by score then identifier.

    With ``fan_in`` above one, each source is first cut down inside that many groups of map
    tasks. Every source has few rows per task but a large library has very many tasks, and
    without the extra level all of them would meet in the one task that owns the source.
    """
    order = [F.col("score").desc(), F.col("target_id")]
    if fan_in > 1:
        group = F.spark_partition_id() % fan_in
        by_group = Window.partitionBy("source_id", "_group").orderBy(*order)
        scored = (
            scored.withColumn("_group", group)
            .withColumn("_rank", F.row_number().over(by_group))
            .where(F.col("_rank") <= n)
            .drop("_group", "_rank")
        )
    by_source = Window.partitionBy("source_id").orderBy(*order)
    return scored.withColumn("match_rank", F.row_number().over(by_source)).where(
        F.col("match_rank") <= n
    )


def top_matches(scored: DataFrame, n: int, fan_in: int = 1) -> DataFrame:
    """Top ``n`` targets per source with a flag for a boundary that cut through a tie.

    ``scored`` holds source_id, target_id and a double score. A source never matches itself;
    another item with an equal fingerprint still does. The flag marks the rows that hold the
    n-th score when the row after it holds that score too, compared before any rounding.
    """
    others = scored.where(F.col("source_id") != F.col("target_id"))
    ranked = best_scores(others, n + 1, fan_in)
    marked = ranked.select(
        "*",
        F.when(F.col("match_rank") == n, F.col("score")).alias("_at_n"),
        F.when(F.col("match_rank") == n + 1, F.col("score")).alias("_after_n"),
    )
    source = Window.partitionBy("source_id")
    return (
        marked.select(
            "*",
            F.max("_at_n").over(source).alias("_last_in"),
            F.max("_after_n").over(source).alias("_first_out"),
        )
        .where(F.col("match_rank") <= n)
        .select(
            "source_id",
            "target_id",
            F.col("score").cast(SCORE).alias("tanimoto_score"),
            F.coalesce(
                (F.col("score") == F.col("_last_in")) & (F.col("_first_out") == F.col("_last_in")),
                F.lit(False),
            ).alias(TIE_FLAG),
            "match_rank",
        )
    )
