"""Bronze to silver: typed, joined molecules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmart.functions.casts import safe_decimal, yes_no
from kinmart.schemas import CAST_COLUMNS, DECIMAL, KEY, MOLECULE, PHASE


def conform(dictionary: DataFrame, properties: DataFrame, structures: DataFrame) -> DataFrame:
    """One row per molecule that has a structure, with text numbers cast to decimals.

    Only the columns silver keeps are read, so wide bronze text such as mol files stays on
    disk. All joins are on the key; sizes decide how they run.
    """
    structure = structures.where(F.col("canonical_smiles").isNotNull()).select(
        KEY, "canonical_smiles", "standard_inchi_key"
    )
    named = dictionary.select(
        KEY,
        "molecule_type",
        "pref_name",
        safe_decimal(F.col("max_phase"), PHASE.simpleString()).alias("max_phase"),
        "structure_type",
    )
    kind = DECIMAL.simpleString()
    measured = properties.select(
        KEY,
        *[safe_decimal(F.col(name), kind).alias(name) for name in CAST_COLUMNS],
        *["aromatic_rings", "heavy_atoms", "hba", "hbd", "rtb", "num_ro5_violations"],
        yes_no(F.col("ro3_pass")).alias("ro3_pass"),
    )
    absent = [
        F.lit(None).cast(MOLECULE[name].dataType).alias(name)
        for name in ("cx_logp", "molecular_species")
    ]
    return (
        structure.join(named, KEY)
        .join(measured, KEY, "left")
        .select("*", *absent)
        .select(*MOLECULE.fieldNames())
    )
