"""How the given tables play the roles of the mart's inputs.

Each role is a table and a list of expressions that Spark and the checking engine read alike.
Cases produce the messy values the operators are about: junk numbers, blank and unknown
names, missing sub-documents. Every role covers every row of its table.
"""

from __future__ import annotations

from dataclasses import dataclass


def padded(prefix: str, key: str) -> str:
    """A text identifier that sorts like its number."""
    return f"concat('{prefix}', lpad(CAST({key} AS STRING), 12, '0'))"


def money(key: str) -> str:
    """A two-digit amount as an exact decimal."""
    return f"CAST({key} AS DECIMAL(14,2))"


def money_text(key: str) -> str:
    return f"CAST({money(key)} AS STRING)"


@dataclass(frozen=True)
class Role:
    table: str
    columns: tuple[str, ...]

    def sql(self) -> str:
        return f"SELECT {', '.join(self.columns)} FROM {self.table}"


LABELLED = "labels JOIN documents USING (doc_id)"

NULL_TEXT = "CAST(NULL AS STRING)"
NULL_INT = "CAST(NULL AS INT)"

_DICTIONARY_REST_TEXT = ("usan_stem", "usan_substem", "usan_stem_definition", "helm_notation")

DOCUMENT_DICTIONARY = Role(
    "documents",
    (
        f"{padded('D', 'doc_id')} AS molecule_id",
        "concat('Text ', CAST(doc_id AS STRING)) AS pref_name",
        "CASE lang WHEN 'en' THEN '4.0' WHEN 'de' THEN ' 3.5 ' WHEN 'es' THEN 'n/a' "
        "ELSE '123.4' END AS max_phase",
        "lang AS molecule_type",
        "source AS structure_type",
    ),
)

DOCUMENT_STRUCTURES = Role(
    "documents",
    (
        f"{padded('D', 'doc_id')} AS molecule_id",
        "text AS canonical_smiles",
        "md5(text) AS standard_inchi_key",
    ),
)

DOCUMENT_PROPERTIES = Role(
    LABELLED,
    (
        f"{padded('D', 'doc_id')} AS molecule_id",
        "concat(CAST(CAST(floor(n_chars / 1000) AS BIGINT) AS STRING), '.', "
        "lpad(CAST(n_chars % 1000 AS STRING), 3, '0')) AS alogp",
        "CASE quality WHEN 1 THEN concat(' ', CAST(n_chars AS STRING), ' ') ELSE 'abc' END AS psa",
        "concat(CAST(n_chars AS STRING), 'e-1') AS mw_freebase",
        "CASE toxic WHEN 1 THEN '+5' ELSE CAST(n_chars AS STRING) END AS full_mwt",
        "concat('-', CAST(n_chars AS STRING), '.5') AS qed_weighted",
        "CASE quality WHEN 1 THEN '' ELSE '1.5d' END AS np_likeness_score",
        "CASE quality WHEN 1 THEN 'y' ELSE CASE toxic WHEN 1 THEN 'N' ELSE 'maybe' END END "
        "AS ro3_pass",
        "quality AS aromatic_rings",
        "toxic AS heavy_atoms",
        "CAST(n_chars % 7 AS INT) AS hba",
        "CAST(n_chars % 5 AS INT) AS hbd",
        "CAST(n_chars % 3 AS INT) AS rtb",
        "CAST(n_chars % 2 AS INT) AS num_ro5_violations",
    ),
)

NATION_INPUTS = Role(
    "nation",
    (
        "concat('batch_', CAST(n_regionkey AS STRING), '.csv') AS source_file",
        "CAST(n_nationkey + 2 AS BIGINT) AS source_row",
        "n_name AS compound_id",
        "CASE n_regionkey WHEN 0 THEN concat('  text ', CAST(n_nationkey * 5 AS STRING), ' ') "
        "WHEN 1 THEN concat('TEXT ', CAST(n_nationkey AS STRING)) "
        "WHEN 2 THEN concat('text ', CAST(n_nationkey - 1 AS STRING)) "
        "WHEN 3 THEN 'nope' ELSE '   ' END AS compound_name",
    ),
)

CUSTOMER_MOLECULES = Role(
    "customer",
    (
        f"{padded('C', 'c_custkey')} AS molecule_id",
        "c_mktsegment AS canonical_smiles",
        "c_name AS pref_name",
    ),
)

ORDER_INPUTS = Role(
    "orders",
    (
        "o_orderpriority AS source_file",
        "o_orderkey AS source_row",
        f"{padded('O', 'o_orderkey')} AS compound_id",
        "CASE WHEN o_orderstatus = 'P' THEN '  ' WHEN o_orderpriority = '1-URGENT' "
        "THEN concat('nope ', CAST(o_custkey AS STRING)) "
        "ELSE concat(' customer#', lpad(CAST(o_custkey AS STRING), 9, '0'), ' ') END "
        "AS compound_name",
    ),
)

CUSTOMER_RELEASE = Role(
    "customer",
    (
        "c_custkey AS record_no",
        "c_name AS molecule_id",
        "upper(c_mktsegment) AS pref_name",
        f"{money('c_acctbal')} AS max_phase",
        "c_mktsegment AS molecule_type",
        "'MOL' AS structure_type",
        f"{money('c_acctbal')} AS first_approval",
        "c_nationkey AS availability_type",
        "c_nationkey + 1950 AS usan_year",
        *[f"{NULL_TEXT} AS {name}" for name in _DICTIONARY_REST_TEXT],
        "c_nationkey AS black_box_warning",
        "-c_nationkey AS chemical_probe",
        *[
            f"{NULL_INT} AS {name}"
            for name in ("chirality", "first_in_class", "inorganic_flag", "natural_product")
        ],
        *[f"c_nationkey AS {name}" for name in ("orphan", "polymer_flag", "prodrug", "veterinary")],
        "CASE WHEN c_nationkey < 5 THEN 1 WHEN c_nationkey < 10 THEN 0 END AS dosed_ingredient",
        "c_nationkey AS oral",
        "1 AS parenteral",
        "0 AS topical",
        f"{NULL_INT} AS therapeutic_flag",
        "CASE c_mktsegment WHEN 'MACHINERY' THEN 1 ELSE 0 END AS withdrawn_flag",
    ),
)

ORDER_RELEASE_PROPERTIES = Role(
    "orders",
    (
        "o_custkey AS record_no",
        f"{money('o_totalprice')} AS alogp",
        "CAST(o_orderkey AS DECIMAL(14,0)) AS psa",
        f"-{money('o_totalprice')} AS mw_freebase",
        f"{NULL_INT} AS full_mwt",
        "o_orderpriority AS full_molformula",
        "o_orderkey AS qed_weighted",
        "o_custkey AS np_likeness_score",
        "o_orderstatus AS ro3_pass",
        f"{money('o_totalprice')} AS aromatic_rings",
        "o_orderkey AS heavy_atoms",
        f"{NULL_INT} AS hba",
        "1 AS hbd",
        "2 AS rtb",
        "3 AS num_ro5_violations",
    ),
)

PART_RELEASE = Role("part", ("p_partkey AS record_no", f"{padded('P', 'p_partkey')} AS molecule_id"))

LINE_RELEASE_STRUCTURES = Role(
    "lineitem",
    (
        "l_partkey AS record_no",
        "concat(l_returnflag, l_linestatus) AS canonical_smiles",
        "CAST(l_orderkey AS STRING) AS standard_inchi",
        "CAST(l_linenumber AS STRING) AS standard_inchi_key",
        "concat(CAST(l_orderkey AS STRING), ' ', CAST(l_suppkey AS STRING)) AS molfile",
    ),
)

SUPPLIER_RELEASE_LOOKUP = Role(
    "supplier",
    (
        "s_name AS molecule_id",
        "'SUPPLIER' AS entity_type",
        f"{money('s_acctbal')} AS entity_id",
        "s_nationkey AS last_active",
        "CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status",
    ),
)

# Number text of every kind the cast accepts or refuses.
PART_NUMBERS = Role(
    "part",
    (
        "p_partkey",
        f"CASE WHEN p_size < 5 THEN 'abc' WHEN p_size < 10 THEN '+5' WHEN p_size < 13 THEN '.5' "
        f"WHEN p_size < 16 THEN '5.' WHEN p_size < 19 THEN 'NaN' WHEN p_size < 22 THEN '' "
        f"WHEN p_size < 25 THEN CAST(NULL AS STRING) WHEN p_size < 28 THEN '1,0' "
        f"WHEN p_size < 31 THEN concat(' ', {money_text('p_retailprice')}, ' ') "
        f"WHEN p_size < 34 THEN concat({money_text('p_retailprice')}, 'e2') "
        f"WHEN p_size < 37 THEN concat('-', {money_text('p_retailprice')}, 'E-1') "
        f"WHEN p_size < 40 THEN '1e30' ELSE {money_text('p_retailprice')} END AS raw",
    ),
)

# JSON records: no id, null, empty and absent sub-documents, a sub-document of nulls.
EVENT_RECORD = (
    "concat('{\"molecule_id\": ', "
    "CASE event_type WHEN 'error' THEN '\"\"' ELSE concat('\"E', CAST(event_id AS STRING), '\"') END, "
    "', \"pref_name\": \"', event_type, '\", \"max_phase\": \"', CAST(user_id AS STRING), '.0\"', "
    "', \"first_approval\": ', CAST(user_id AS STRING), ', \"oral\": ', "
    "CASE WHEN user_id < 50 THEN 'true' WHEN user_id < 100 THEN 'false' ELSE 'null' END, "
    "CASE event_type WHEN 'view' THEN ', \"molecule_properties\": null' "
    "WHEN 'click' THEN ', \"molecule_properties\": {}' "
    "WHEN 'signup' THEN ', \"molecule_properties\": {\"alogp\": null}' "
    "WHEN 'purchase' THEN concat(', \"molecule_properties\": {\"alogp\": \"1.310\", "
    "\"heavy_atoms\": ', CAST(user_id AS STRING), '}') "
    "ELSE '' END, "
    "CASE event_type WHEN 'purchase' THEN concat(', \"molecule_structures\": "
    "{\"canonical_smiles\": \"C', CAST(event_id AS STRING), '\", \"molfile\": \"a\\\\nb\"}') "
    "WHEN 'view' THEN ', \"molecule_structures\": {}' ELSE '' END, '}')"
)

CUSTOMER_RECORD = (
    "concat('{', CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'FURNITURE' "
    "THEN '\"molecule_id\": \"\", ' ELSE concat('\"molecule_id\": \"', c_name, '\", ') END, "
    "'\"entity_type\": \"', c_mktsegment, '\", \"last_active\": ', CAST(c_nationkey AS STRING), "
    "', \"resource_url\": \"/x/', CAST(c_custkey AS STRING), '\", \"status\": null}')"
)

# Drafts with the defects the gold checks look for.
DRAFT_FACT = Role(
    "lineitem",
    (
        f"{padded('M', 'l_suppkey')} AS source_id",
        f"{padded('M', 'l_partkey')} AS target_id",
        "CAST(l_quantity / 40 AS DECIMAL(9,8)) AS tanimoto_score",
        "CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END "
        "AS has_duplicates_of_last_largest_score",
    ),
)

DRAFT_DIM = Role(
    "part",
    (
        f"{padded('M', 'p_partkey + 20')} AS molecule_id",
        "CASE WHEN p_size > 10 THEN CAST(p_size AS DECIMAL(28,8)) END AS alogp",
        "CASE WHEN p_size > 45 THEN CAST(1 AS DECIMAL(28,8)) END AS cx_logp",
        "CASE p_brand WHEN 'Brand#17' THEN 'ACID' END AS molecular_species",
    ),
)

DRAFT_SOURCES = Role(
    "supplier",
    (
        f"{padded('M', 's_suppkey + 3')} AS molecule_id",
        "CASE WHEN s_acctbal > 1000 THEN 'x' END AS canonical_smiles",
        "CASE WHEN s_nationkey < 8 THEN 'input_file' WHEN s_nationkey < 16 THEN 'top_up' "
        "WHEN s_nationkey < 20 THEN 'guess' END AS origin",
    ),
)
