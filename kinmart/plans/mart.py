"""Dimension, fact and the five delivery views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmart.schemas import DIM_MOLECULE, FACT_SIMILARITY, KEY
from kinmart.workspace import stage

TOTAL = "TOTAL"


def referenced_ids(pairs: DataFrame) -> DataFrame:
    """Every id that is a source or a target, once."""
    sources = pairs.select(F.col("source_id").alias(KEY))
    return sources.union(pairs.select("target_id")).distinct()


def dim_molecule(molecules: DataFrame, top: DataFrame) -> DataFrame:
    """Molecules the top matches mention.

    The ids, few for each source, are staged: with their size known beforehand the library
    is filtered where it is read and never shuffled.
    """
    ids = stage(referenced_ids(top), "referenced")
    return molecules.select(*DIM_MOLECULE.fieldNames()).join(ids, KEY, "left_semi")


def fact_similarity(top: DataFrame) -> DataFrame:
    """The top matches without their rank."""
    return top.select(*FACT_SIMILARITY.fieldNames())


def avg_similarity(fact: DataFrame) -> DataFrame:
    """Mean score over each source's matches."""
    return fact.groupBy("source_id").agg(F.avg("tanimoto_score").alias("avg_tanimoto_score"))


def top_sources(fact: DataFrame, limit: int) -> DataFrame:
    """The sources with the highest mean score."""
    best = [F.col("avg_tanimoto_score").desc(), F.col("source_id")]
    return avg_similarity(fact).orderBy(*best).limit(limit)


def avg_deviation(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean absolute alogp gap between a source and its matches; null pairs do not count."""
    source = dim.select(F.col(KEY).alias("source_id"), F.col("alogp").alias("source_alogp"))
    target = dim.select(F.col(KEY).alias("target_id"), F.col("alogp").alias("target_alogp"))
    gap = F.abs(F.col("target_alogp") - F.col("source_alogp"))
    return (
        fact.join(source, "source_id")
        .join(target, "target_id")
        .groupBy("source_id")
        .agg(F.avg(gap).alias("avg_alogp_deviation"))
    )


def pivot_sources(fact: DataFrame, count: int) -> DataFrame:
    """The lowest ``count`` source ids: the same columns on every rebuild."""
    return fact.select("source_id").distinct().orderBy("source_id").limit(count)


def similarity_pivot(fact: DataFrame, count: int) -> DataFrame:
    """Targets as rows, the chosen sources as columns, scores in the cells."""
    names = [row[0] for row in pivot_sources(fact, count).collect()]
    if not names:
        raise ValueError("the fact table holds no source")
    chosen = fact.where(F.col("source_id").isin(names))
    return chosen.groupBy("target_id").pivot("source_id", names).agg(F.max("tanimoto_score"))


def similarity_neighbours(fact: DataFrame) -> DataFrame:
    """Each match with the next one down, and with the source's second best."""
    ranked = Window.partitionBy("source_id").orderBy(F.col("tanimoto_score").desc(), "target_id")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return fact.select(
        "source_id",
        "target_id",
        "tanimoto_score",
        F.lead("target_id").over(ranked).alias("next_most_similar_target"),
        F.nth_value("target_id", 2).over(whole).alias("second_most_similar_target"),
    )


def _label(name: str) -> Column:
    """The group's own value, null included, unless the grouping set collapsed the column."""
    own = F.grouping(name) == 0
    return F.when(own, F.col(name).cast("string")).otherwise(TOTAL)


def similarity_rollup(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean score by source, by rings and atoms, by atoms, and overall, in one pass."""
    shape = dim.select(F.col(KEY).alias("source_id"), "aromatic_rings", "heavy_atoms")
    joined = fact.select("source_id", "tanimoto_score").join(shape, "source_id")
    source, rings, atoms = (F.col(n) for n in ("source_id", "aromatic_rings", "heavy_atoms"))
    sets = [[source], [rings, atoms], [atoms], []]
    return joined.groupingSets(sets, source, rings, atoms).agg(
        _label("source_id").alias("source_molecule"),
        _label("aromatic_rings").alias("rings"),
        _label("heavy_atoms").alias("atoms"),
        F.avg("tanimoto_score").alias("avg_tanimoto_score"),
    ).select(
        "source_molecule",
        F.col("rings").alias("aromatic_rings"),
        F.col("atoms").alias("heavy_atoms"),
        "avg_tanimoto_score",
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table: table_name, row_count."""
    counted = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    out = counted[0]
    for frame in counted[1:]:
        out = out.unionAll(frame)
    return out
