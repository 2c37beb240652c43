"""Layouts of the bronze, silver, gold and meta tables.

Column names, order and types are fixed values: they are the contract between the layers.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "molecule_id"

DECIMAL = T.DecimalType(28, 8)
PHASE = T.DecimalType(3, 1)
SCORE = T.DecimalType(9, 8)


def _struct(*groups: tuple[T.DataType, tuple[str, ...]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for kind, names in groups for name in names])


TEXT, INT, LONG, FLAG = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

ID_LOOKUP = _struct(
    (TEXT, (KEY, "entity_type")),
    (LONG, ("entity_id",)),
    (INT, ("last_active",)),
    (TEXT, ("resource_url", "status")),
)

MOLECULE_DICTIONARY = _struct(
    (TEXT, (KEY, "pref_name", "max_phase", "molecule_type", "structure_type")),
    (INT, ("first_approval", "availability_type", "usan_year")),
    (TEXT, ("usan_stem", "usan_substem", "usan_stem_definition", "helm_notation")),
    (
        INT,
        (
            "black_box_warning",
            "chemical_probe",
            "chirality",
            "first_in_class",
            "inorganic_flag",
            "natural_product",
            "orphan",
            "polymer_flag",
            "prodrug",
            "veterinary",
        ),
    ),
    (
        FLAG,
        ("dosed_ingredient", "oral", "parenteral", "topical", "therapeutic_flag", "withdrawn_flag"),
    ),
)

COMPOUND_PROPERTIES = _struct(
    (
        TEXT,
        (
            KEY,
            "alogp",
            "psa",
            "mw_freebase",
            "full_mwt",
            "full_molformula",
            "qed_weighted",
            "np_likeness_score",
            "ro3_pass",
        ),
    ),
    (INT, ("aromatic_rings", "heavy_atoms", "hba", "hbd", "rtb", "num_ro5_violations")),
)

COMPOUND_STRUCTURES = _struct(
    (TEXT, (KEY, "canonical_smiles", "standard_inchi", "standard_inchi_key", "molfile")),
)

INPUT_COLUMNS = (
    "compound_id",
    "compound_name",
    "molecular_weight",
    "logp",
    "ic50_nm",
    "assay_date",
    "collection_date",
    "lab_id",
)
NAME_COLUMN = "compound_name"

INPUT_COMPOUND = _struct((TEXT, ("source_file",)), (LONG, ("source_row",)), (TEXT, INPUT_COLUMNS))

# When a row was written. An upsert refreshes it, a rebuild writes it anew.
LOADED = "loaded_at"

CAST_COLUMNS = ("mw_freebase", "full_mwt", "alogp", "psa", "qed_weighted", "np_likeness_score")

MOLECULE = _struct(
    (TEXT, (KEY, "molecule_type", "pref_name")),
    (PHASE, ("max_phase",)),
    (TEXT, ("structure_type", "canonical_smiles", "standard_inchi_key")),
    (DECIMAL, CAST_COLUMNS),
    (INT, ("aromatic_rings", "heavy_atoms", "hba", "hbd", "rtb", "num_ro5_violations")),
    (FLAG, ("ro3_pass",)),
    (DECIMAL, ("cx_logp",)),
    (TEXT, ("molecular_species",)),
)

ORIGINS = ("input_file", "top_up")
REASON_BLANK = "compound name is blank"
REASON_UNKNOWN = "name matches no preferred name"

SOURCE_MOLECULE = _struct(
    (TEXT, (KEY, "canonical_smiles", "origin", "input_compound_id", "input_compound_name")),
)

SOURCE_REJECTED = _struct(
    (TEXT, ("source_file",)),
    (LONG, ("source_row",)),
    (TEXT, ("compound_id", "compound_name", "reason")),
)

TIE_FLAG = "has_duplicates_of_last_largest_score"

SIMILARITY_TOP = _struct(
    (TEXT, ("source_id", "target_id")),
    (SCORE, ("tanimoto_score",)),
    (FLAG, (TIE_FLAG,)),
    (INT, ("match_rank",)),
)

DIM_MOLECULE = _struct(
    (TEXT, (KEY, "molecule_type")),
    (DECIMAL, ("mw_freebase", "alogp", "psa", "cx_logp")),
    (TEXT, ("molecular_species",)),
    (DECIMAL, ("full_mwt",)),
    (INT, ("aromatic_rings", "heavy_atoms")),
)

FACT_SIMILARITY = _struct(
    (TEXT, ("source_id", "target_id")), (SCORE, ("tanimoto_score",)), (FLAG, (TIE_FLAG,))
)

WATERMARK = _struct(
    (TEXT, ("resource", "release")), (LONG, ("next_offset", "total_count")), (FLAG, ("is_complete",))
)

QUALITY_CHECK = _struct(
    (TEXT, ("run_id", "check_name", "layer", "severity")),
    (T.DoubleType(), ("observed",)),
    (TEXT, ("expected",)),
    (FLAG, ("passed",)),
)
