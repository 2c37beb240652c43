from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kinmart.functions.casts import register_safe_numeric, rounded_int, safe_decimal
from kinmart.operators.conform import conform
from kinmart.operators.selection import (
    rejected_rows,
    resolve_names,
    selection_summary,
    source_set,
    top_up,
)
from kinmart.schemas import (
    COMPOUND_PROPERTIES,
    COMPOUND_STRUCTURES,
    KEY,
    MOLECULE,
    MOLECULE_DICTIONARY,
    REASON_BLANK,
    REASON_UNKNOWN,
)

NUMBERS = {
    "1.31": "1.31", " 4.0 ": "4.0", "\t5\n": "5", "1e3": "1000", "1E-2": "0.01", "-7": "-7",
    "0": "0", "+5": None, ".5": None, "5.": None, "NaN": None, "Infinity": None, "": None,
    "abc": None, "1,0": None, "0x10": None, "1.5d": None, "12f": None, "1e30": None, None: None,
    "1 2": None, "--1": None, "1e": None,
}


def test_cast_takes_plain_numbers_only_and_never_raises(spark):
    frame = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    register_safe_numeric(spark)
    made = frame.select("t", safe_decimal(F.col("t")), F.expr("safe_numeric(t)")).collect()
    for text, value, by_sql in made:
        want = NUMBERS[text]
        assert value == by_sql == (None if want is None else Decimal(want)), text


def test_narrow_cast_is_null_on_overflow(spark):
    frame = spark.createDataFrame([("99.9",), ("99.95",), ("4",)], "t string")
    made = [r[0] for r in frame.select(safe_decimal(F.col("t"), "decimal(3,1)")).collect()]
    assert made == [Decimal("99.9"), None, Decimal("4.0")]


def test_integers_round_half_away_from_zero(spark):
    frame = spark.createDataFrame([(2.5,), (-2.5,), (2.4,), (None,)], "v double")
    assert [r[0] for r in frame.select(rounded_int(F.col("v"))).collect()] == [3, -3, 2, None]


def frame(spark, schema, *rows):
    filled = [tuple(row.get(name) for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(filled, schema)


def molecules(spark, *rows):
    return frame(spark, MOLECULE, *[{KEY: r[0], "pref_name": r[1], "canonical_smiles": "C"} for r in rows])


INPUT = "source_file string, source_row bigint, compound_id string, compound_name string"


def test_conform_joins_and_types(spark):
    made = conform(
        frame(
            spark, MOLECULE_DICTIONARY,
            {KEY: "A", "max_phase": "4.0", "molecule_type": "t"}, {KEY: "B"}, {KEY: "N"},
        ),
        frame(spark, COMPOUND_PROPERTIES, {KEY: "A", "alogp": "1.31", "psa": "x", "ro3_pass": "y", "hba": 3}),
        frame(
            spark, COMPOUND_STRUCTURES,
            {KEY: "A", "canonical_smiles": "C"}, {KEY: "B", "canonical_smiles": "D"},
            {KEY: "N"}, {KEY: "X", "canonical_smiles": "E"},
        ),
    )
    assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in MOLECULE]
    by_id = {r[KEY]: r for r in made.collect()}
    assert set(by_id) == {"A", "B"}
    a, b = by_id["A"], by_id["B"]
    assert (a.alogp, a.psa, a.ro3_pass, a.hba, a.max_phase) == (
        Decimal("1.31"), None, True, 3, Decimal("4.0")
    )
    assert (b.alogp, b.ro3_pass, a.cx_logp, a.molecular_species) == (None, None, None, None)


def test_names_match_and_rows_are_accounted_for(spark, rows):
    library = molecules(spark, ("A", "Aspirin"), ("B", "ibuprofen"), ("B2", "IBUPROFEN"), ("N", None))
    given = spark.createDataFrame(
        [
            ("f1", 3, "c3", "ASPIRIN"), ("f1", 2, "c2", "  aspirin "), ("f2", 2, "c9", "Aspirin"),
            ("f2", 3, "c4", "Ibuprofen"), ("f2", 4, "c5", "   "), ("f2", 5, "c6", None),
            ("f2", 6, "c7", "nothing"), ("f2", 7, "c8", "\taspirin"),
        ],
        INPUT,
    )
    made = rows(resolve_names(library, given).select(KEY, "origin", "input_compound_id"))
    assert made == [("A", "input_file", "c2"), ("B", "input_file", "c4"), ("B2", "input_file", "c4")]
    refused = rows(rejected_rows(library, given).select("source_row", "reason"))
    assert refused == [
        (4, REASON_BLANK), (5, REASON_BLANK), (6, REASON_UNKNOWN), (7, REASON_UNKNOWN)
    ]


def test_a_blank_name_matching_a_blank_molecule_is_neither(spark):
    library = molecules(spark, ("A", ""))
    given = spark.createDataFrame([("f", 2, "c", "  ")], INPUT)
    assert resolve_names(library, given).count() == 0
    assert rejected_rows(library, given).count() == 0


@pytest.mark.parametrize(("target", "matched", "added"), [(5, 2, 3), (2, 2, 0), (1, 2, 0), (99, 2, 8)])
def test_top_up_fills_and_never_cuts(spark, target, matched, added):
    library = molecules(spark, *[(f"M{n}", f"name {n}") for n in range(10)])
    given = spark.createDataFrame([("f", 2, "a", "NAME 3"), ("f", 3, "b", "name 7"), ("f", 4, "c", "x")], INPUT)
    made = source_set(library, given, target)
    summary = selection_summary(made, rejected_rows(library, given)).first()
    assert tuple(summary) == (matched, added, 1)


def test_top_up_is_in_md5_order_of_those_not_chosen(spark):
    import hashlib

    names = [f"M{n}" for n in range(30)]
    library = molecules(spark, *[(n, n) for n in names])
    chosen = library.where(f"{KEY} = 'M4'")
    made = {r[KEY] for r in top_up(library, chosen, 6).collect()}
    rest = sorted((n for n in names if n != "M4"), key=lambda n: hashlib.md5(n.encode()).hexdigest())
    assert made == set(rest[:6])


def test_most_rows_may_share_one_name(spark, rows):
    library = molecules(spark, *[(f"M{n}", "same") for n in range(300)], ("X", "other"))
    given = spark.range(5000).selectExpr(
        "'f' AS source_file", "id AS source_row", "CAST(id AS STRING) AS compound_id",
        "CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN 'Same' ELSE 'other' END AS compound_name",
    )
    made = resolve_names(library, given)
    assert made.count() == 301
    assert rows(made.select("input_compound_id").distinct()) == [("1",), ("2",)]
    assert rejected_rows(library, given).count() == 1667


def test_numbers_of_many_digits_keep_their_value(spark):
    texts = ["123456789012345678.5", "-99999999999999999999.12345678", "123456789012345678901"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    made = [r[0] for r in frame.select(safe_decimal(F.col("t"))).collect()]
    assert [None if v is None else format(v, "f") for v in made] == [
        "123456789012345678.50000000",
        "-99999999999999999999.12345678",
        None,
    ]
