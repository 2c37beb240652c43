"""The SQL each registered query is checked against, in DuckDB's dialect.

Written from the definitions and not from the Spark plans: fingerprints are bit strings,
scores start from all pairs, ranks come from plain windows over everything.
"""

from __future__ import annotations

from catalog import inputs
from kinmart import schemas

ORACLES: dict[str, str] = {}


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


def rows_of(name: str, role: inputs.Role) -> str:
    return f"{name} AS ({role.sql()})"


_PLAIN_NUMBER = r"^\s*-?\d+(\.\d+)?([eE][-+]?\d+)?\s*$"


def safe(column: str, kind: str = "DECIMAL(28,8)") -> str:
    return (
        f"CASE WHEN regexp_matches({column}, '{_PLAIN_NUMBER}') "
        f"THEN TRY_CAST(trim({column}) AS {kind}) END"
    )


def avg12(column: str, digits: int = 8) -> str:
    """Average of a decimal, rounded half up to twelve places, from integers."""
    scaled = f"sum(CAST({column} * {10**digits} AS HUGEINT))"
    count = f"count({column})"
    grown = f"({scaled} * {2 * 10 ** (12 - digits)} + {count})"
    return f"CASE WHEN {count} > 0 THEN CAST({grown} // (2 * {count}) AS DOUBLE) / 1e12 END"


# Landing


def absent(layout, *delivered: str) -> str:
    """The columns of a layout that the records don't deliver, as nulls."""
    kinds = {"string": "VARCHAR", "int": "INT", "boolean": "BOOLEAN"}
    return ", ".join(
        f"CAST(NULL AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in layout
        if f.name not in delivered
    )


ORACLES["land_lookup"] = """
SELECT c_name AS molecule_id, c_mktsegment AS entity_type, CAST(NULL AS BIGINT) AS entity_id,
       c_nationkey AS last_active, concat('/x/', c_custkey) AS resource_url,
       CAST(NULL AS VARCHAR) AS status
FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')
"""

ORACLES["land_dictionary"] = """
SELECT concat('E', event_id) AS molecule_id, event_type AS pref_name,
       concat(user_id, '.0') AS max_phase, CAST(user_id AS INT) AS first_approval,
       CASE WHEN user_id < 50 THEN true WHEN user_id < 100 THEN false END AS oral,
       {rest}
FROM events WHERE event_type <> 'error'
""".replace("{rest}", absent(
    schemas.MOLECULE_DICTIONARY, "molecule_id", "pref_name", "max_phase", "first_approval", "oral"))

ORACLES["land_properties"] = """
SELECT concat('E', event_id) AS molecule_id,
       CASE event_type WHEN 'purchase' THEN '1.310' END AS alogp,
       CASE event_type WHEN 'purchase' THEN CAST(user_id AS INT) END AS heavy_atoms,
       {rest}
FROM events WHERE event_type IN ('purchase', 'signup')
""".replace("{rest}", absent(
    schemas.COMPOUND_PROPERTIES, "molecule_id", "alogp", "heavy_atoms"))

ORACLES["land_structures"] = """
SELECT concat('E', event_id) AS molecule_id, concat('C', event_id) AS canonical_smiles,
       concat('a', chr(10), 'b') AS molfile, {rest}
FROM events WHERE event_type = 'purchase'
""".replace("{rest}", absent(
    schemas.COMPOUND_STRUCTURES, "molecule_id", "canonical_smiles", "molfile"))

_WHOLE = "CAST(round({}, 0) AS {})"


def _whole(column: str, kind: str = "INT") -> str:
    return _WHOLE.format(column, kind)


ORACLES["drain_dictionary"] = f"""
{ctes(rows_of("raw", inputs.CUSTOMER_RELEASE))}
SELECT molecule_id, pref_name, CAST(max_phase AS VARCHAR) AS max_phase, molecule_type,
       structure_type, {_whole("first_approval")} AS first_approval,
       {", ".join(f"CAST({n} AS INT) AS {n}" for n in ("availability_type", "usan_year"))},
       usan_stem, usan_substem, usan_stem_definition, CAST(NULL AS VARCHAR) AS helm_notation,
       {", ".join(f"CAST({n} AS INT) AS {n}" for n in (
           "black_box_warning", "chemical_probe", "chirality", "first_in_class",
           "inorganic_flag", "natural_product", "orphan", "polymer_flag", "prodrug",
           "veterinary"))},
       {", ".join(f"{n} = 1 AS {n}" for n in (
           "dosed_ingredient", "oral", "parenteral", "topical", "therapeutic_flag",
           "withdrawn_flag"))}
FROM raw
"""

ORACLES["drain_properties"] = f"""
{ctes(rows_of("raw", inputs.ORDER_RELEASE_PROPERTIES))}
SELECT c_name AS molecule_id,
       {", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in (
           "alogp", "psa", "mw_freebase", "full_mwt", "full_molformula", "qed_weighted",
           "np_likeness_score", "ro3_pass"))},
       {_whole("aromatic_rings")} AS aromatic_rings,
       {", ".join(f"CAST({n} AS INT) AS {n}" for n in (
           "heavy_atoms", "hba", "hbd", "rtb", "num_ro5_violations"))}
FROM raw JOIN customer ON c_custkey = record_no
"""

ORACLES["drain_structures"] = f"""
{ctes(rows_of("raw", inputs.LINE_RELEASE_STRUCTURES), rows_of("keys", inputs.PART_RELEASE))}
SELECT molecule_id, canonical_smiles, standard_inchi, standard_inchi_key, molfile
FROM raw JOIN keys USING (record_no)
"""

ORACLES["drain_lookup"] = f"""
{ctes(rows_of("raw", inputs.SUPPLIER_RELEASE_LOOKUP))}
SELECT molecule_id, entity_type, {_whole("entity_id", "BIGINT")} AS entity_id,
       CAST(last_active AS INT) AS last_active, CAST(NULL AS VARCHAR) AS resource_url, status
FROM raw
"""

ORACLES["land_csv"] = """
SELECT CASE WHEN p_size < 17 THEN CAST(p_partkey AS VARCHAR) END AS compound_id,
       CASE WHEN p_size >= 17 AND p_size < 34
            THEN concat('say "', p_name, '",', chr(10), 'then ', p_type)
            ELSE p_name END AS compound_name,
       CAST(NULL AS VARCHAR) AS molecular_weight, CAST(NULL AS VARCHAR) AS logp,
       CASE WHEN p_size >= 17 AND p_size < 34 THEN CAST(p_size AS VARCHAR) END AS ic50_nm,
       CAST(NULL AS VARCHAR) AS assay_date,
       CASE WHEN p_size >= 34 AND p_size <= 45 THEN '2024-01-25' END AS collection_date,
       CASE WHEN p_size < 34 THEN p_brand END AS lab_id,
       CASE WHEN p_size < 17 THEN 'a' WHEN p_size < 34 THEN 'b' ELSE 'c' END AS source_file,
       1 + row_number() OVER (
           PARTITION BY CASE WHEN p_size < 17 THEN 0 WHEN p_size < 34 THEN 1 ELSE 2 END
           ORDER BY p_partkey) AS source_row
FROM part
"""

ORACLES["csv_refused"] = """
SELECT 'bad' AS folder, 's_suppkey,s_name,s_nationkey,s_acctbal' AS headers,
       count(*) AS landed_rows
FROM part
"""

ORACLES["csv_row_numbers"] = """
SELECT count(*) AS landed_rows, CAST(0 AS BIGINT) AS files_with_gaps FROM part
"""

ORACLES["csv_unknown_headers"] = """
SELECT DISTINCT CASE WHEN p_size < 34 THEN 'mystery' ELSE 'p_type' END AS header
FROM part WHERE p_size >= 17
"""

# Casts and conforming

ORACLES["safe_numeric"] = f"""
{ctes(rows_of("raws", inputs.PART_NUMBERS))}
SELECT p_partkey, CAST({safe("raw")} AS DOUBLE) AS number FROM raws
"""

_NUMBERS = ("mw_freebase", "full_mwt", "alogp", "psa", "qed_weighted", "np_likeness_score")
_COUNTS = ("aromatic_rings", "heavy_atoms", "hba", "hbd", "rtb", "num_ro5_violations")

BRONZE = (
    rows_of("dictionary", inputs.DOCUMENT_DICTIONARY),
    rows_of("properties", inputs.DOCUMENT_PROPERTIES),
    rows_of("structures", inputs.DOCUMENT_STRUCTURES),
)

MOLECULES = (
    *BRONZE,
    f"""molecules AS (
    SELECT s.molecule_id, d.molecule_type, d.pref_name,
           {safe("d.max_phase", "DECIMAL(3,1)")} AS max_phase, d.structure_type,
           s.canonical_smiles, s.standard_inchi_key,
           {", ".join(f"{safe(f'p.{n}')} AS {n}" for n in _NUMBERS)},
           {", ".join(f"p.{n}" for n in _COUNTS)},
           CASE upper(p.ro3_pass) WHEN 'Y' THEN true WHEN 'N' THEN false END AS ro3_pass,
           CAST(NULL AS DECIMAL(28,8)) AS cx_logp, CAST(NULL AS VARCHAR) AS molecular_species
    FROM structures s JOIN dictionary d USING (molecule_id)
    LEFT JOIN properties p USING (molecule_id)
    WHERE s.canonical_smiles IS NOT NULL)""",
)


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


ORACLES["conform_molecules"] = f"""
{ctes(*MOLECULES)}
SELECT molecule_id, molecule_type, pref_name, {_doubles("max_phase")}, structure_type,
       standard_inchi_key, {_doubles(*_NUMBERS)}, {", ".join(_COUNTS)}, ro3_pass,
       {_doubles("cx_logp")}, molecular_species
FROM molecules
"""

# Source selection

CUSTOMERS = (
    rows_of("library", inputs.CUSTOMER_MOLECULES),
    rows_of("given", inputs.ORDER_INPUTS),
)

_SAME_NAME = "upper(m.pref_name) = upper(trim(i.compound_name, ' '))"


def matched(molecules: str, given: str) -> str:
    return f"""matched AS (
    SELECT molecule_id, canonical_smiles, 'input_file' AS origin,
           compound_id AS input_compound_id, compound_name AS input_compound_name
    FROM (SELECT m.molecule_id, m.canonical_smiles, i.compound_id, i.compound_name,
                 row_number() OVER (PARTITION BY m.molecule_id
                                    ORDER BY i.source_file, i.source_row) AS place
          FROM {given} i JOIN {molecules} m ON {_SAME_NAME}
          WHERE trim(coalesce(i.compound_name, ''), ' ') <> '')
    WHERE place = 1)"""


def rejected(molecules: str, given: str) -> str:
    return f"""rejected AS (
    SELECT source_file, source_row, compound_id, compound_name,
           CASE WHEN trim(coalesce(compound_name, ''), ' ') = '' THEN 'compound name is blank'
                ELSE 'name matches no preferred name' END AS reason
    FROM {given} i
    WHERE NOT EXISTS (SELECT 1 FROM {molecules} m WHERE {_SAME_NAME}))"""


ORACLES["resolve_names"] = f"{ctes(*CUSTOMERS, matched('library', 'given'))} SELECT * FROM matched"

ORACLES["rejected_rows"] = (
    f"{ctes(*CUSTOMERS, rejected('library', 'given'))} SELECT * FROM rejected"
)

_ADDED = """molecule_id, canonical_smiles, 'top_up' AS origin,
       CAST(NULL AS VARCHAR) AS input_compound_id, CAST(NULL AS VARCHAR) AS input_compound_name"""

ORACLES["top_up"] = f"""
{ctes(*CUSTOMERS, matched("library", "given"))}
SELECT {_ADDED} FROM library WHERE molecule_id NOT IN (SELECT molecule_id FROM matched)
ORDER BY md5(molecule_id), molecule_id LIMIT 50
"""

SOURCES = (
    *MOLECULES,
    rows_of("given", inputs.NATION_INPUTS),
    matched("molecules", "given"),
    rejected("molecules", "given"),
    f"""added AS (
    SELECT {_ADDED},
           row_number() OVER (ORDER BY md5(molecule_id), molecule_id) AS place
    FROM molecules WHERE molecule_id NOT IN (SELECT molecule_id FROM matched))""",
    """sources AS (
    SELECT * FROM matched UNION ALL
    SELECT * EXCLUDE (place) FROM added WHERE place <= 100 - (SELECT count(*) FROM matched))""",
)

ORACLES["source_set"] = f"""
{ctes(*SOURCES)}
SELECT molecule_id, origin, input_compound_id, input_compound_name FROM sources
"""

ORACLES["source_summary"] = f"""
{ctes(*SOURCES)}
SELECT count(*) FILTER (WHERE origin = 'input_file') AS from_input,
       count(*) FILTER (WHERE origin = 'top_up') AS topped_up,
       (SELECT count(*) FROM rejected) AS rejected
FROM sources
"""

ORACLES["first_per_key"] = """
SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders
ORDER BY o_custkey, o_totalprice DESC, o_orderkey
"""

ORACLES["latest_per_key"] = """
SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value FROM events
ORDER BY user_id, event_type, ts DESC, event_id DESC
"""

# Fingerprints

_SPACE = "concat(' ', chr(9), chr(10), chr(12), chr(13))"


def token_list(text: str) -> str:
    return rf"string_split_regex(trim({text}, {_SPACE}), '[ \t\r\n\f]+')"


def hashed(features: str, n_bits: int) -> str:
    """Bits of a two-column relation (item_id, feature)."""
    return f"""bits AS (
    SELECT DISTINCT item_id,
           CAST(('0x' || substr(md5(feature), 1, 8))::BIGINT % {n_bits} AS INT) AS bit
    FROM {features})"""


def token_features(items: str, text: str, sizes: int) -> tuple[str, ...]:
    runs = " UNION ALL ".join(
        f"SELECT item_id, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS feature "
        f"FROM (SELECT item_id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words)"
        for n in range(1, sizes + 1)
    )
    return (
        f"words AS (SELECT item_id, {token_list(text)} AS w FROM {items})",
        f"features AS ({runs})",
    )


def words_select(n_words: int) -> str:
    return f"""
SELECT item_id, CAST(sum(n) AS INT) AS pc,
       string_agg(CAST(CASE WHEN value >= 9223372036854775808 THEN value - 18446744073709551616
                            ELSE value END AS VARCHAR), ',' ORDER BY word) AS words
FROM (SELECT i.item_id, w.word, count(bit) AS n,
             coalesce(sum(CAST(1::UBIGINT << (bit % 64) AS HUGEINT)), 0) AS value
      FROM (SELECT DISTINCT item_id FROM items) i
      CROSS JOIN (SELECT unnest(range(0, {n_words})) AS word) w
      LEFT JOIN bits b ON b.item_id = i.item_id AND b.bit // 64 = w.word
      GROUP BY i.item_id, w.word)
GROUP BY item_id
"""


DOCUMENT_BITS = (
    f"items AS (SELECT {inputs.padded('D', 'doc_id')} AS item_id, text FROM documents)",
    *token_features("items", "text", 3),
    hashed("features", 2048),
)

ORACLES["fingerprint_library"] = ctes(*DOCUMENT_BITS) + words_select(32)

ORACLES["published_library"] = f"""
{ctes(*DOCUMENT_BITS,
      "ids AS (SELECT item_id AS id, count(*) AS pc FROM bits GROUP BY item_id)",
      "placed AS (SELECT id, pc, (row_number() OVER (ORDER BY id) - 1) // 250 AS shard FROM ids)")}
SELECT shard, min(id) AS first_id, max(id) AS last_id, count(*) AS items,
       CAST(sum(pc) AS BIGINT) AS bits, CAST(32 AS INT) AS n_words, CAST(1 AS BIGINT) AS files
FROM placed GROUP BY shard
"""

ORACLES["fingerprint_exchange"] = f"""
{ctes(*DOCUMENT_BITS,
      "marked AS (SELECT i.item_id, n // 8 AS byte, sum(CASE WHEN b.bit IS NOT NULL "
      "THEN 1 << CAST(7 - n % 8 AS INT) ELSE 0 END) AS value "
      "FROM (SELECT DISTINCT item_id FROM bits) i CROSS JOIN range(2048) AS r(n) "
      "LEFT JOIN bits b ON b.item_id = i.item_id AND b.bit = n GROUP BY i.item_id, n // 8)")}
SELECT item_id, string_agg(lower(printf('%02x', CAST(value AS INT))), '' ORDER BY byte) AS packed,
       CAST(sum(bit_count(CAST(value AS INT))) AS INT) AS pc
FROM marked GROUP BY item_id
"""

ORACLES["qgram_fingerprints"] = (
    ctes(
        "items AS (SELECT CAST(page_id AS VARCHAR) AS item_id, url FROM pages)",
        "features AS (SELECT item_id, substr(url, i, 4) AS feature FROM "
        "(SELECT item_id, url, unnest(range(1, greatest(length(url) - 2, 2))) AS i FROM items))",
        hashed("features", 512),
    )
    + words_select(8)
)

VECTOR_BITS = (
    "items AS (SELECT CAST(vec_id AS VARCHAR) AS item_id, embedding FROM embeddings)",
    "bits AS (SELECT item_id, CAST(i - 1 AS INT) AS bit FROM (SELECT item_id, embedding[i] AS v, i "
    "FROM (SELECT item_id, embedding, unnest(range(1, 65)) AS i FROM items)) WHERE v > 0)",
)

ORACLES["vector_fingerprints"] = ctes(*VECTOR_BITS) + words_select(1)

PATCHY = (
    f"patchy AS (SELECT {inputs.padded('D', 'doc_id')} AS item_id, "
    "CASE lang WHEN 'fr' THEN NULL WHEN 'es' THEN ' ' ELSE text END AS structure FROM documents)"
)

ORACLES["fingerprint_rejects"] = f"""
{ctes(PATCHY)}
SELECT item_id, CASE WHEN structure IS NULL THEN 'structure is missing'
                     ELSE 'structure is blank' END AS reason
FROM patchy WHERE structure IS NULL OR trim(structure) = ''
"""

ORACLES["fingerprint_summary"] = f"""
{ctes(PATCHY)}
SELECT CAST(ceil(count(*) FILTER (WHERE trim(structure) <> '') / 100.0) AS BIGINT) AS shards,
       count(*) FILTER (WHERE trim(structure) <> '') AS fingerprints,
       count(*) FILTER (WHERE coalesce(trim(structure), '') = '') AS rejected,
       count(*) FILTER (WHERE trim(structure) <> '') * 128 AS packed_bytes
FROM patchy
"""


def plan_of(ids: str, size: int) -> tuple[str, ...]:
    return (
        f"placed AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM {ids})",
        f"plan AS (SELECT place // {size} AS shard, id AS first_id, "
        f"lead(id) OVER (ORDER BY id) AS next_id FROM placed WHERE place % {size} = 0)",
    )


_ORDER_IDS = f"ids AS (SELECT {inputs.padded('O', 'o_orderkey')} AS id FROM orders)"

ORACLES["shard_plan"] = f"{ctes(_ORDER_IDS, *plan_of('ids', 1000))} SELECT * FROM plan"

ORACLES["range_scan"] = f"""
{ctes(*DOCUMENT_BITS,
      "ids AS (SELECT item_id AS id, CAST(count(*) AS INT) AS pc FROM bits GROUP BY item_id)",
      "placed AS (SELECT id, pc, (row_number() OVER (ORDER BY id) - 1) // 90 AS shard FROM ids)")}
SELECT shard, id AS item_id, pc FROM placed
WHERE shard = 1 OR shard = (SELECT max(shard) FROM placed)
"""

# Scoring

ORACLES["missing_fingerprints"] = f"""
SELECT {inputs.padded("D", "c_custkey")} AS source_id FROM customer
WHERE c_custkey NOT IN (SELECT doc_id FROM documents)
"""


def scored(n_bits: int, chosen: str) -> tuple[str, ...]:
    """Every chosen item against every item, scores from bit strings."""
    return (
        f"packed AS (SELECT i.item_id, bitstring_agg(bit, 0, {n_bits - 1}) AS fp, "
        "count(bit) AS pc FROM items i JOIN bits b USING (item_id) GROUP BY i.item_id)",
        f"""scored AS (
    SELECT source_id, target_id, CASE WHEN a + b - shared > 0
               THEN CAST(shared AS DOUBLE) / (a + b - shared) ELSE 0.0 END AS score
    FROM (SELECT s.item_id AS source_id, t.item_id AS target_id, s.pc AS a, t.pc AS b,
                 bit_count(s.fp & t.fp) AS shared
          FROM packed s CROSS JOIN packed t
          WHERE s.item_id IN (SELECT source_id FROM {chosen})))""",
    )


def top(n: int) -> str:
    return f"""top AS (
    SELECT source_id, target_id, CAST(score AS DECIMAL(9,8)) AS tanimoto_score,
           score = boundary AND at_least > {n} AS has_duplicates_of_last_largest_score,
           CAST(place AS INT) AS match_rank
    FROM (SELECT *, count(*) FILTER (WHERE score >= boundary)
                    OVER (PARTITION BY source_id) AS at_least
          FROM (SELECT *, min(CASE WHEN place <= {n} THEN score END)
                          OVER (PARTITION BY source_id) AS boundary
                FROM (SELECT *, row_number() OVER (PARTITION BY source_id
                                                   ORDER BY score DESC, target_id) AS place
                      FROM scored WHERE source_id <> target_id)))
    WHERE place <= {n})"""


_TOP_COLUMNS = f"""source_id, target_id, {_doubles("tanimoto_score")},
       has_duplicates_of_last_largest_score, match_rank"""

SOURCE_IDS = "source_ids AS (SELECT molecule_id AS source_id FROM sources)"

SCORED = (*SOURCES, SOURCE_IDS, *DOCUMENT_BITS, *scored(2048, "source_ids"))
TOP = (*SCORED, top(10))

ORACLES["score_table"] = f"""
{ctes(*SCORED)}
SELECT source_id, target_id, CAST(CAST(score AS FLOAT) AS DOUBLE) AS tanimoto_score FROM scored
"""

ORACLES["score_archive"] = f"""
{ctes(*SCORED)}
SELECT source_id, count(*) AS targets, count(*) FILTER (WHERE source_id = target_id) AS self_rows,
       CAST(max(CAST(score AS FLOAT)) AS DOUBLE) AS highest,
       CAST(min(CAST(score AS FLOAT)) AS DOUBLE) AS lowest
FROM scored GROUP BY source_id
"""

ORACLES["top_matches"] = f"{ctes(*TOP)} SELECT {_TOP_COLUMNS} FROM top"

ORACLES["top_matches_vectors"] = f"""
{ctes(*VECTOR_BITS,
      "chosen AS (SELECT CAST(vec_id AS VARCHAR) AS source_id FROM embeddings WHERE vec_id % 20 = 0)",
      *scored(64, "chosen"), top(10))}
SELECT {_TOP_COLUMNS} FROM top
"""

_DISCOUNTS = (
    f"scored AS (SELECT {inputs.padded('O', 'l_orderkey')} AS source_id, "
    f"{inputs.padded('L', 'l_linenumber')} AS target_id, CAST(l_discount AS DOUBLE) AS score "
    "FROM lineitem)"
)

ORACLES["top_matches_tied"] = f"{ctes(_DISCOUNTS, top(2))} SELECT {_TOP_COLUMNS} FROM top"
ORACLES["top_matches_short"] = f"{ctes(_DISCOUNTS, top(10))} SELECT {_TOP_COLUMNS} FROM top"

ORACLES["search_summary"] = f"""
{ctes(*TOP)}
SELECT count(DISTINCT source_id) AS sources, count(*) AS top_rows,
       count(*) FILTER (WHERE has_duplicates_of_last_largest_score) AS flagged_rows
FROM top
"""

ORACLES["pair_scores"] = (
    f"{ctes(*TOP)} SELECT source_id, target_id, {_doubles('tanimoto_score')} FROM top"
)

# Mart and views

DIM = (
    *TOP,
    """dim AS (
    SELECT molecule_id, molecule_type, mw_freebase, alogp, psa, cx_logp, molecular_species,
           full_mwt, aromatic_rings, heavy_atoms
    FROM molecules WHERE molecule_id IN (
        SELECT source_id FROM top UNION SELECT target_id FROM top))""",
)

ORACLES["dim_build"] = f"""
{ctes(*DIM)}
SELECT molecule_id, molecule_type, {_doubles("mw_freebase", "alogp", "psa", "cx_logp")},
       molecular_species, {_doubles("full_mwt")}, aromatic_rings, heavy_atoms
FROM dim
"""

ORACLES["fact_build"] = f"""
{ctes(*TOP)}
SELECT source_id, target_id, {_doubles("tanimoto_score")}, has_duplicates_of_last_largest_score
FROM top
"""

ORACLES["avg_similarity"] = f"""
{ctes(*TOP)}
SELECT source_id, {avg12("tanimoto_score")} AS avg_tanimoto_score FROM top GROUP BY source_id
"""

ORACLES["top_sources"] = f"""
{ctes(*TOP)}
SELECT source_id, {avg12("tanimoto_score")} AS avg_tanimoto_score FROM top GROUP BY source_id
ORDER BY avg_tanimoto_score DESC, source_id LIMIT 3
"""

ORACLES["avg_deviation"] = f"""
{ctes(*DIM)}
SELECT source_id, {avg12("gap")} AS avg_alogp_deviation
FROM (SELECT f.source_id, abs(t.alogp - s.alogp) AS gap
      FROM top f JOIN dim s ON s.molecule_id = f.source_id
      JOIN dim t ON t.molecule_id = f.target_id)
GROUP BY source_id
"""

PIVOT_SOURCES = (
    "pivots AS (SELECT source_id, row_number() OVER (ORDER BY source_id) AS place "
    "FROM (SELECT DISTINCT source_id FROM top) ORDER BY source_id LIMIT 10)"
)

ORACLES["pivot_sources"] = f"{ctes(*TOP, PIVOT_SOURCES)} SELECT source_id FROM pivots"

ORACLES["similarity_pivot"] = f"""
{ctes(*TOP, PIVOT_SOURCES)}
SELECT target_id,
       {", ".join(
           f"CAST(max(tanimoto_score) FILTER (WHERE place = {n}) AS DOUBLE) AS source_{n:02d}"
           for n in range(1, 11))}
FROM top JOIN pivots USING (source_id) GROUP BY target_id
"""

ORACLES["similarity_neighbours"] = f"""
{ctes(*TOP)}
SELECT source_id, target_id, {_doubles("tanimoto_score")},
       lead(target_id) OVER ranked AS next_most_similar_target,
       nth_value(target_id, 2) OVER (PARTITION BY source_id ORDER BY tanimoto_score DESC, target_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_most_similar_target
FROM top WINDOW ranked AS (PARTITION BY source_id ORDER BY tanimoto_score DESC, target_id)
"""

_MEAN = avg12("tanimoto_score")

ORACLES["similarity_rollup"] = f"""
{ctes(*DIM, "joined AS (SELECT source_id, tanimoto_score, aromatic_rings, heavy_atoms "
            "FROM top JOIN dim ON molecule_id = source_id)")}
SELECT source_id AS source_molecule, 'TOTAL' AS aromatic_rings, 'TOTAL' AS heavy_atoms,
       {_MEAN} AS avg_tanimoto_score FROM joined GROUP BY source_id
UNION ALL
SELECT 'TOTAL', CAST(aromatic_rings AS VARCHAR), CAST(heavy_atoms AS VARCHAR), {_MEAN}
FROM joined GROUP BY aromatic_rings, heavy_atoms
UNION ALL
SELECT 'TOTAL', 'TOTAL', CAST(heavy_atoms AS VARCHAR), {_MEAN} FROM joined GROUP BY heavy_atoms
UNION ALL
SELECT 'TOTAL', 'TOTAL', 'TOTAL', {_MEAN} FROM joined
"""

_COUNTED = {
    "silver.molecule": "molecules",
    "silver.source_molecule": "sources",
    "silver.source_molecule_rejected": "rejected",
    "silver.fingerprint": "packed",
    "gold.dim_molecule": "dim",
    "gold.fact_molecule_similarity": "top",
}

ORACLES["layer_counts"] = ctes(*DIM) + " UNION ALL ".join(
    f"\nSELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
    for name, table in _COUNTED.items()
)

# Quality

def silver_draft(molecules: str = "molecules") -> tuple[str, ...]:
    return (
        *MOLECULES,
        "named AS (SELECT * FROM dictionary)",
        f"""draft AS (
    SELECT * REPLACE (CASE WHEN molecule_type = 'fr' THEN '  '
                           WHEN NOT coalesce(ro3_pass, false) THEN canonical_smiles END
                      AS canonical_smiles)
    FROM {molecules})""",
        "held AS (SELECT * FROM draft UNION ALL SELECT * FROM draft WHERE aromatic_rings = 0)",
    )


def source_draft(chosen: str = "matched", refused: str = "rejected") -> tuple[str, ...]:
    return (
        *CUSTOMERS,
        matched("library", "given"),
        rejected("library", "given"),
        rows_of("extra", inputs.DRAFT_SOURCES),
        f"""chosen AS (
    SELECT molecule_id, canonical_smiles, origin FROM {chosen}
    UNION ALL SELECT molecule_id, canonical_smiles, origin FROM extra)""",
        f"""refused AS (
    SELECT * REPLACE (CASE WHEN reason <> 'compound name is blank' THEN source_row END
                      AS source_row)
    FROM {refused})""",
    )


# Every row, and drafts that have lost some rows for the checks that count these.
SILVER_DRAFT, SOURCE_DRAFT = silver_draft(), source_draft()
SILVER_DROPPED = silver_draft("(SELECT * FROM molecules WHERE molecule_type <> 'es')")
SOURCE_DROPPED = source_draft(
    "(SELECT * FROM matched WHERE canonical_smiles <> 'BUILDING')",
    "(SELECT * FROM rejected WHERE source_file <> '5-LOW')",
)

GOLD_DRAFT = (
    rows_of("fact", inputs.DRAFT_FACT),
    rows_of("dim", inputs.DRAFT_DIM),
    rows_of("sources", inputs.DRAFT_SOURCES),
)

_LOST = " OR ".join(
    f"(p.{n} IS NOT NULL AND trim(p.{n}, ' ') <> '' AND m.{n} IS NULL)" for n in _NUMBERS
)

_LOW = "(SELECT min(tanimoto_score) FROM fact g WHERE g.source_id = f.source_id)"


def repeated(relation: str, *keys: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {', '.join(keys)} FROM {relation} "
        f"GROUP BY ALL HAVING count(*) > 1)"
    )


_CHECKS: dict[str, tuple[tuple[str, ...], str]] = {
    "molecules_are_populated": (SILVER_DRAFT, "SELECT count(*) FROM held"),
    "every_structure_is_kept": (
        SILVER_DROPPED,
        "SELECT count(*) FROM structures s JOIN named d USING (molecule_id) "
        "LEFT JOIN held m USING (molecule_id) "
        "WHERE s.canonical_smiles IS NOT NULL AND m.pref_name IS NULL",
    ),
    "structure_is_never_blank": (
        SILVER_DRAFT,
        "SELECT count(*) FROM held WHERE trim(canonical_smiles, ' ') = ''",
    ),
    "casts_drop_nothing": (
        SILVER_DRAFT,
        "SELECT count(*) FROM held m JOIN named d USING (molecule_id) "
        "LEFT JOIN properties p USING (molecule_id) WHERE "
        f"(trim(d.max_phase, ' ') <> '' AND m.max_phase IS NULL) OR {_LOST}",
    ),
    "molecule_key_is_unique": (SILVER_DRAFT, repeated("held", "molecule_id")),
    "molecule_columns_are_filled": (
        SILVER_DRAFT,
        "SELECT count(*) FROM held WHERE molecule_id IS NULL OR canonical_smiles IS NULL",
    ),
    "every_input_row_is_accounted_for": (
        SOURCE_DROPPED,
        "SELECT count(*) FROM given i WHERE NOT EXISTS (SELECT 1 FROM refused r "
        "WHERE r.source_file = i.source_file AND r.source_row = i.source_row) "
        "AND NOT EXISTS (SELECT 1 FROM chosen s JOIN library m USING (molecule_id) "
        f"WHERE s.origin = 'input_file' AND {_SAME_NAME})",
    ),
    "source_set_has_its_size": (SOURCE_DRAFT, "SELECT count(*) FROM chosen"),
    "source_set_has_input_molecules": (
        SOURCE_DRAFT,
        "SELECT count(*) FROM chosen WHERE origin = 'input_file'",
    ),
    "source_key_is_unique": (SOURCE_DRAFT, repeated("chosen", "molecule_id")),
    "source_columns_are_filled": (
        SOURCE_DRAFT,
        "SELECT count(*) FROM chosen WHERE molecule_id IS NULL OR canonical_smiles IS NULL "
        "OR origin IS NULL",
    ),
    "source_origin_is_known": (
        SOURCE_DRAFT,
        "SELECT count(*) FROM chosen WHERE origin NOT IN ('input_file', 'top_up')",
    ),
    "input_key_is_unique": (SOURCE_DRAFT, repeated("given", "source_file", "source_row")),
    "rejected_key_is_unique": (SOURCE_DRAFT, repeated("refused", "source_file", "source_row")),
    "rejected_columns_are_filled": (
        SOURCE_DRAFT,
        "SELECT count(*) FROM refused WHERE source_file IS NULL OR source_row IS NULL "
        "OR reason IS NULL",
    ),
    "fact_has_no_self_match": (
        GOLD_DRAFT,
        "SELECT count(*) FROM fact WHERE source_id = target_id",
    ),
    "fact_has_top_n_per_source": (
        GOLD_DRAFT,
        "SELECT count(*) FROM (SELECT source_id FROM fact GROUP BY source_id "
        "HAVING count(*) <> 600)",
    ),
    "fact_sources_are_in_source_set": (
        GOLD_DRAFT,
        "SELECT count(DISTINCT source_id) FROM fact "
        "WHERE source_id NOT IN (SELECT molecule_id FROM sources)",
    ),
    "dim_has_no_unreferenced_molecule": (
        GOLD_DRAFT,
        "SELECT count(*) FROM dim WHERE molecule_id NOT IN (SELECT source_id FROM fact) "
        "AND molecule_id NOT IN (SELECT target_id FROM fact)",
    ),
    "tie_flag_is_only_on_boundary": (
        GOLD_DRAFT,
        "SELECT count(*) FROM (SELECT *, min(tanimoto_score) OVER (PARTITION BY source_id) AS low "
        "FROM fact) WHERE has_duplicates_of_last_largest_score AND tanimoto_score <> low",
    ),
    "tie_flag_agrees_on_boundary": (
        GOLD_DRAFT,
        f"SELECT count(*) FROM (SELECT source_id FROM fact f WHERE tanimoto_score = {_LOW} "
        "GROUP BY source_id HAVING count(DISTINCT has_duplicates_of_last_largest_score) > 1)",
    ),
    "dim_alogp_coverage_is_high": (
        GOLD_DRAFT,
        "SELECT coalesce(CAST(count(alogp) AS DOUBLE) / count(*), 0) FROM dim",
    ),
    "gap_columns_are_still_empty": (
        GOLD_DRAFT,
        "SELECT count(*) FROM dim WHERE cx_logp IS NOT NULL OR molecular_species IS NOT NULL",
    ),
    "every_source_has_matches": (
        GOLD_DRAFT,
        "SELECT count(*) FROM sources WHERE molecule_id NOT IN (SELECT source_id FROM fact)",
    ),
    "dim_key_is_unique": (GOLD_DRAFT, repeated("dim", "molecule_id")),
    "fact_key_is_unique": (GOLD_DRAFT, repeated("fact", "source_id", "target_id")),
    "fact_ids_are_in_dim": (
        GOLD_DRAFT,
        "SELECT count(*) FROM (SELECT source_id AS id FROM fact UNION ALL "
        "SELECT target_id FROM fact) WHERE id NOT IN (SELECT molecule_id FROM dim)",
    ),
    "fact_score_is_in_range": (
        GOLD_DRAFT,
        "SELECT count(*) FROM fact WHERE tanimoto_score < 0 OR tanimoto_score > 1",
    ),
    "fact_columns_are_filled": (
        GOLD_DRAFT,
        "SELECT count(*) FROM fact WHERE source_id IS NULL OR target_id IS NULL "
        "OR tanimoto_score IS NULL OR has_duplicates_of_last_largest_score IS NULL",
    ),
}

for _name, (_parts, _sql) in _CHECKS.items():
    ORACLES[f"check_{_name}"] = (
        f"{ctes(*_parts)} SELECT '{_name}' AS check_name, CAST(({_sql}) AS DOUBLE) AS observed"
    )

ORACLES["gate_gold"] = ctes(*GOLD_DRAFT) + " UNION ALL ".join(
    f"\nSELECT '{name}' AS check_name, CAST(({sql}) AS DOUBLE) AS observed"
    for name, (parts, sql) in _CHECKS.items()
    if parts is GOLD_DRAFT
)

# The same statements over the finished mart, judged by what each one expects.
_EXPECTED = {
    "molecules_are_populated": ("block", ">= 1"),
    "source_set_has_its_size": ("warn", "= 100"),
    "source_set_has_input_molecules": ("block", ">= 1"),
    "dim_alogp_coverage_is_high": ("warn", ">= 0.9"),
    "gap_columns_are_still_empty": ("warn", "= 0"),
}

_FINISHED = (
    *DIM,
    "named AS (SELECT * FROM dictionary)",
    "held AS (SELECT * FROM molecules)",
    "library AS (SELECT * FROM molecules)",
    "chosen AS (SELECT * FROM sources)",
    "refused AS (SELECT * FROM rejected)",
    "fact AS (SELECT * FROM top)",
)


def _judged(name: str, sql: str) -> str:
    severity, holds = _EXPECTED.get(name, ("block", "= 0"))
    return f"SELECT '{severity}' AS severity, ({sql.replace('<> 600', '<> 10')}) {holds} AS ok"


ORACLES["gate_report"] = f"""
{ctes(*_FINISHED)}
SELECT 'documents' AS run_id, count(*) AS checks, count(*) FILTER (WHERE ok) AS passed,
       count(*) FILTER (WHERE NOT ok AND severity = 'warn') AS warnings,
       count(*) FILTER (WHERE NOT ok AND severity = 'block') AS blocking
FROM ({" UNION ALL ".join(_judged(name, sql) for name, (_, sql) in _CHECKS.items())})
"""

ORACLES["check_width"] = f"""
{ctes(*DOCUMENT_BITS)}
SELECT item_id FROM bits WHERE bit = 63
"""

ORACLES["check_library_complete"] = """
SELECT CAST(count(*) FILTER (WHERE lang IN ('fr', 'es')) AS DOUBLE) AS observed FROM documents
"""

ORACLES["quality_latest"] = """
SELECT DISTINCT ON (event_type, user_id) concat(event_type, user_id) AS check_name,
       CAST(event_id AS VARCHAR) AS run_id, value AS observed
FROM events ORDER BY event_type, user_id, ts DESC
"""

# Incremental landing

ORACLES["upsert_latest"] = """
WITH ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type
        ORDER BY dayofweek(ts) IN (0, 6), ts DESC, event_id DESC) AS place
    FROM events)
SELECT user_id, event_type, event_id, value FROM ranked WHERE place = 1
"""

ORACLES["stream_land"] = """
SELECT DISTINCT ON (user_id) concat('U', user_id) AS molecule_id, event_type AS pref_name,
       CAST(event_id AS INT) AS first_approval
FROM events ORDER BY user_id, event_id DESC
"""

ORACLES["stream_watermark"] = """
SELECT 'r1' AS release, count(*) AS next_offset, count(*) AS total_count, true AS is_complete
FROM events
"""

ORACLES["stream_restart"] = """
WITH sizes AS (
    SELECT count(*) FILTER (WHERE event_id // 250 % 2 = 0) AS even,
           count(*) FILTER (WHERE event_id // 250 % 2 = 1) AS odd,
           count(*) FILTER (WHERE event_type = 'purchase') AS newer
    FROM events),
newest AS (
    SELECT DISTINCT ON (user_id) user_id, event_type, event_id FROM events
    ORDER BY user_id, event_type = 'purchase' DESC, event_id DESC)
SELECT concat('U', user_id) AS molecule_id, event_type AS pref_name,
       CAST(event_id AS INT) AS first_approval, false AS complete_early, true AS complete_late,
       concat_ws(',', even, odd, 0, newer, newer) AS landed
FROM newest, sizes
"""

ORACLES["stream_no_offset"] = """
SELECT concat('U', user_id) AS molecule_id,
       count(*) FILTER (WHERE event_id % 2 = 0 AND event_type = 'click') > 0 AS renewed
FROM events
GROUP BY user_id
HAVING count(*) FILTER (WHERE event_id % 2 = 1 OR event_type = 'click') > 0
"""

ORACLES["safe_numeric_sql"] = ORACLES["safe_numeric"]

ORACLES["stream_corrected"] = """
WITH paged AS (SELECT *, (c_custkey // 50) % 2 = 0 AS even FROM customer)
SELECT concat('C', c_custkey) AS molecule_id,
       CASE WHEN even THEN concat(c_name, '!') ELSE c_name END AS pref_name,
       c_nationkey AS first_approval, true AS is_timed, 'false,false,true' AS complete,
       concat((SELECT count(*) FROM paged WHERE even), ',0,',
              (SELECT count(*) FROM paged WHERE NOT even)) AS landed
FROM paged
"""

ORACLES["store_rebuild"] = """
SELECT s_suppkey, s_name, s_acctbal, CAST(3 AS INT) AS commits, true AS is_same, true AS is_timed
FROM supplier
"""
