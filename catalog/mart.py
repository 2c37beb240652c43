"""The mart over the given documents, its layers built on first use and staged.

Like any warehouse, a view reads the stored layer below it instead of rebuilding it. Layers
are kept per application and input folder, so nothing outlives the session that made it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from kinmart import Settings
from kinmart.operators import fingerprints, selection, similarity
from kinmart.operators.conform import conform
from kinmart.plans import mart as marts
from kinmart.schemas import KEY
from kinmart.workspace import new_dir, stage

SETTINGS = Settings()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, given: inputs.Role) -> DataFrame:
    """A role's rows."""
    if given.table == inputs.LABELLED:
        rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    else:
        rows = table(spark, sf_dir, given.table)
    return rows.selectExpr(*given.columns)


class DocumentMart:
    """Documents as molecules, nations as the delivered input rows."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def role(self, given: inputs.Role) -> DataFrame:
        return role(self.spark, self.sf_dir, given)

    @cached_property
    def molecules(self) -> DataFrame:
        return stage(
            conform(
                self.role(inputs.DOCUMENT_DICTIONARY),
                self.role(inputs.DOCUMENT_PROPERTIES),
                self.role(inputs.DOCUMENT_STRUCTURES),
            ),
            "molecules",
        )

    @cached_property
    def nation_inputs(self) -> DataFrame:
        return self.role(inputs.NATION_INPUTS)

    @cached_property
    def sources(self) -> DataFrame:
        made = selection.source_set(self.molecules, self.nation_inputs, SETTINGS.target_size)
        return stage(made, "source_set")

    @cached_property
    def source_ids(self) -> DataFrame:
        return self.sources.select(F.col(KEY).alias("source_id"))

    @cached_property
    def rejected(self) -> DataFrame:
        return stage(selection.rejected_rows(self.molecules, self.nation_inputs), "rejected")

    def fingerprints(self) -> DataFrame:
        """The fingerprints of all documents, computed anew."""
        return fingerprints.text_fingerprints(
            self.role(inputs.DOCUMENT_STRUCTURES), KEY, "canonical_smiles", SETTINGS
        )

    @cached_property
    def library(self) -> DataFrame:
        path = new_dir(self.spark, "library")
        fingerprints.publish_library(self.fingerprints(), path, SETTINGS)
        return self.spark.read.parquet(path)

    @cached_property
    def library_by_bits(self) -> DataFrame:
        return fingerprints.by_popcount(self.library, new_dir(self.spark, "library-by-bits"))

    @cached_property
    def top(self) -> DataFrame:
        return stage(similarity.search(self.library_by_bits, self.source_ids, SETTINGS), "top")

    @cached_property
    def dim(self) -> DataFrame:
        return stage(marts.dim_molecule(self.molecules, self.top), "dim")

    @cached_property
    def fact(self) -> DataFrame:
        return stage(marts.fact_similarity(self.top), "fact")


_OPEN: dict[tuple[str, str], DocumentMart] = {}


def document_mart(spark: SparkSession, sf_dir: str) -> DocumentMart:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = DocumentMart(spark, sf_dir)
    return _OPEN[key]
