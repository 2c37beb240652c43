import json
import random

import pytest
from pyspark.sql import functions as F

from kinmart.schemas import INPUT_COLUMNS, KEY
from kinmart.sources import release
from kinmart.sources.batches import (
    INSIDE,
    KEEP,
    OUTSIDE,
    SWAP,
    UnnamedBatches,
    land_batches,
    line_effect,
    read_lines,
    read_records,
)
from kinmart.sources.records import MoleculeLayout, lookup_rows, molecule_tables

STANDARD = (
    "lab_id,compound_name,logp,compound_id\n"
    "North,Fenolan,0.75,K-7\n"
    "South,Morbital,-1.2,K-8\n"
)


def write(folder, **files):
    for name, text in files.items():
        data = text if isinstance(text, bytes) else text.encode()
        (folder / f"{name}.csv").write_bytes(data)
    return str(folder)


def row(number, **cells):
    """One landed row: its number, then a cell for each known column."""
    return (number, *[cells.get(name) for name in INPUT_COLUMNS])


def landed(spark, path):
    made = land_batches(spark, path)
    out = {}
    for row in made.rows.collect():
        out.setdefault(row.source_file, []).append(tuple(row)[1:])
    unknown = {(r.source_file, r.header) for r in made.unknown_headers.collect()}
    return {name: sorted(found) for name, found in out.items()}, unknown


CASES = {
    "standard": (
        STANDARD,
        [
            row(2, lab_id="North", compound_name="Fenolan", logp="0.75", compound_id="K-7"),
            row(3, lab_id="South", compound_name="Morbital", logp="-1.2", compound_id="K-8"),
        ],
    ),
    "some_columns": ("compound_name,compound_id\n,K-1\n", [row(2, compound_id="K-1")]),
    "mixed": (
        " Compound_NAME ,IC50_nM,collection_date\n Salvone , 12 ,2019-05-03\n",
        [row(2, compound_name="Salvone", ic50_nm="12", collection_date="2019-05-03")],
    ),
    "blank_lines": (
        STANDARD + "\n , ,,\nWest,Tarine,3,K-9\n",
        [
            row(2, lab_id="North", compound_name="Fenolan", logp="0.75", compound_id="K-7"),
            row(3, lab_id="South", compound_name="Morbital", logp="-1.2", compound_id="K-8"),
            row(6, lab_id="West", compound_name="Tarine", logp="3", compound_id="K-9"),
        ],
    ),
    "unknown": ("colour,compound_name\nred,Ilmenol\n", [row(2, compound_name="Ilmenol")]),
    "marked": ("\ufeffcompound_name\nIlmenol\n", [row(2, compound_name="Ilmenol")]),
    "short": ("lab_id,compound_name,logp\nEast,Ilmenol\n", [row(2, lab_id="East", compound_name="Ilmenol")]),
    "long": ("compound_name\nIlmenol,more,cells\n", [row(2, compound_name="Ilmenol")]),
    "repeated": (
        "compound_name,lab_id,compound_name\nfirst,East,second\n",
        [row(2, compound_name="second", lab_id="East")],
    ),
    "windows": (
        'compound_name,lab_id\r\nIlmenol,A\r\n"on two\r\nlines",B\r\n',
        [
            row(2, compound_name="Ilmenol", lab_id="A"),
            row(3, compound_name="on two\r\nlines", lab_id="B"),
        ],
    ),
    "no_last_break": ("compound_name\nIlmenol\nEnd", [row(2, compound_name="Ilmenol"), row(3, compound_name="End")]),
    "quotes": (
        'compound_name,lab_id\n"a, b",1\n"say ""hi""",2\n5" pipe,3\n"one\ntwo\n\nthree",4\n'
        'x,"y\n",\n"closed"tail,5\nlast,7\n',
        [
            row(2, compound_name="a, b", lab_id="1"),
            row(3, compound_name='say "hi"', lab_id="2"),
            row(4, compound_name='5" pipe', lab_id="3"),
            row(5, compound_name="one\ntwo\n\nthree", lab_id="4"),
            row(6, compound_name="x", lab_id="y"),
            row(7, compound_name="closedtail", lab_id="5"),
            row(8, compound_name="last", lab_id="7"),
        ],
    ),
}


def test_every_case_lands_as_written_out(spark, tmp_path):
    files = {name: text for name, (text, _) in CASES.items()}
    made, unknown = landed(spark, write(tmp_path, **files))
    assert made == {f"{name}.csv": rows for name, (_, rows) in CASES.items()}
    assert unknown == {("unknown.csv", "colour")}


def test_files_of_one_name_in_two_folders_stay_apart(spark, tmp_path):
    for folder, name in (("jan", "Ilmenol"), ("feb 1%", "Tarine")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.csv").write_text(f"compound_name\n{name}\n")
    made, _ = landed(spark, str(tmp_path))
    assert made == {
        "jan/x.csv": [row(2, compound_name="Ilmenol")],
        "feb 1%/x.csv": [row(2, compound_name="Tarine")],
    }


def test_a_field_may_be_long(spark, tmp_path):
    name = "long, " * 200_000
    made, _ = landed(spark, write(tmp_path, wide=f'compound_name,lab_id\n"{name}",A\n'))
    assert made == {"wide.csv": [row(2, compound_name=name.strip(), lab_id="A")]}


def test_empty_file_other_extension_and_bad_bytes(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("compound_name\nno\n")
    (tmp_path / "UP.CSV").write_bytes(b"compound_name\nIlm\xffenol\n")
    write(tmp_path, empty="")
    made, _ = landed(spark, str(tmp_path))
    assert set(made) == {"UP.CSV"} and made["UP.CSV"][0][2] == "Ilm�enol"


def test_a_file_without_names_is_refused(spark, tmp_path):
    path = write(tmp_path, good=STANDARD, nameless="logp,lab_id\n1,North\n")
    with pytest.raises(UnnamedBatches, match="lab_id.* of nameless.csv"):
        land_batches(spark, path)
    made = land_batches(spark, path, strict=False)
    assert [tuple(r) for r in made.refused.collect()] == [("nameless.csv", ["logp", "lab_id"])]
    assert {r.source_file for r in made.rows.collect()} == {"good.csv"}


def random_file(seed, n):
    """A file of random records as text, and the rows it must land as."""
    rnd = random.Random(seed)
    cells = {"a": "a", 'b"c': 'b"c', '"q"': "q", '"two\nlines"': "two\nlines", '"x ""y"" z"': 'x "y" z'}
    cells |= {"": None, '"a,b"': "a,b", '"\n\n"': None, "é ü": "é ü"}
    text, rows, columns = ["compound_name,lab_id,logp"], [], ("compound_name", "lab_id", "logp")
    for number in range(2, n + 2):
        picked = rnd.choices(list(cells), k=rnd.randint(0, 4))
        text.append(",".join(picked))
        values = {c: cells[x] for c, x in zip(columns, picked)}
        if any(cells[x] for x in picked):
            rows.append(row(number, **values))
    return "\n".join(text) + "\n", rows


def test_files_split_over_tasks_keep_their_row_numbers(spark, tmp_path):
    files = {f"f{seed}": random_file(seed, 120) for seed in range(4)}
    path = write(tmp_path, **{name: text for name, (text, _) in files.items()})
    size, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    spark.conf.set(size, "300b")
    spark.conf.set(cost, "0")
    try:
        assert read_lines(spark, path).select("path", "split").distinct().count() > 12
        made, _ = landed(spark, path)
    finally:
        spark.conf.unset(size)
        spark.conf.unset(cost)
    assert made == {f"{name}.csv": rows for name, (_, rows) in files.items()}


def test_an_unclosed_quote_lands_or_is_refused_as_asked(spark, tmp_path):
    path = write(tmp_path, open="compound_name\n" + '"never closed\n' + "more text\n" * 50)
    assert land_batches(spark, path).rows.count() == 1
    with pytest.raises(Exception, match="over 200 characters"):
        land_batches(spark, path, longest=200)


def test_no_whole_file_in_one_row(spark, tmp_path):
    path = write(tmp_path, standard=STANDARD)
    records = read_records(read_lines(spark, path))
    assert records.count() == 3
    assert records.agg(F.max(F.length("record"))).first()[0] < len(STANDARD) / 2


@pytest.mark.parametrize(
    ("line", "effect"),
    [
        (None, KEEP), ("a,b", KEEP), ('""', KEEP), ('"a",b', OUTSIDE), ('b",c', OUTSIDE),
        ('"a" "b",c', OUTSIDE), ('5" x', OUTSIDE), ('b",",', INSIDE), ('a,"b', SWAP), ('"', SWAP),
        ('"a""', SWAP),
    ],
)
def test_effect_of_a_line_on_quoting(line, effect):
    assert line_effect(line) == effect


def records(spark, *given):
    return spark.createDataFrame([(json.dumps(g),) for g in given], "record string")


FULL = {
    KEY: "M1",
    "pref_name": "ASPIRIN",
    "max_phase": "4.0",
    "oral": True,
    "veterinary": 0,
    "molecule_properties": {"alogp": "1.310", "aromatic_rings": 1},
    "molecule_structures": {"canonical_smiles": "CC", "molfile": "a\nb"},
    "ignored": {"deep": [1]},
}


def test_a_record_feeds_three_tables(spark):
    made = molecule_tables(records(spark, FULL))
    row = made.dictionary.first()
    assert (row[KEY], row.pref_name, row.max_phase, row.oral, row.veterinary) == (
        "M1", "ASPIRIN", "4.0", True, 0
    )
    assert row.usan_stem is None
    assert made.properties.select(KEY, "alogp", "aromatic_rings", "psa").first() == (
        "M1", "1.310", 1, None
    )
    assert made.structures.first().molfile == "a\nb"


@pytest.mark.parametrize(
    ("document", "count"), [(None, 0), ({}, 0), ({"alogp": None}, 1), ("absent", 0)]
)
def test_optional_sub_documents(spark, document, count):
    record = {KEY: "M1"} if document == "absent" else {KEY: "M1", "molecule_properties": document}
    made = molecule_tables(records(spark, record))
    assert (made.dictionary.count(), made.properties.count(), made.structures.count()) == (1, count, 0)


def test_records_without_an_identifier_are_skipped(spark):
    given = [{"pref_name": "x"}, {KEY: ""}, {KEY: None}, {KEY: "M1"}]
    made = molecule_tables(records(spark, *given))
    assert [r[KEY] for r in made.dictionary.collect()] == ["M1"]
    assert [r[KEY] for r in lookup_rows(records(spark, *given)).collect()] == ["M1"]


def test_identifier_field_may_have_another_name(spark):
    layout = MoleculeLayout(id_field="code")
    made = molecule_tables(records(spark, {"code": "M9", "pref_name": "p"}), layout=layout)
    assert made.dictionary.columns[0] == KEY and made.dictionary.first()[KEY] == "M9"


def test_broken_records_raise(spark):
    broken = spark.createDataFrame([('{"molecule_id": ',)], "record string")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        lookup_rows(broken).collect()


def test_only_needed_fields_are_parsed(spark):
    made = molecule_tables(records(spark, FULL)).structures.select(KEY)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "alogp" not in plan


def test_drains_cast_flags_numbers_and_keys(spark):
    lookup = spark.createDataFrame(
        [("M1", "T", 2.5, 1, "ACTIVE"), ("M2", "T", None, None, None)],
        f"{KEY} string, entity_type string, entity_id double, last_active int, status string",
    )
    made = {r[KEY]: r for r in release.drain_lookup(lookup).collect()}
    assert made["M1"].entity_id == 3 and made["M1"].resource_url is None
    assert made["M2"].entity_id is None
    keys = spark.createDataFrame([(7, "M7")], f"n int, {KEY} string")
    raw = spark.createDataFrame(
        [(7, "C", "i", "k", "m"), (8, "N", "i", "k", "m")],
        "n int, canonical_smiles string, standard_inchi string, standard_inchi_key string, "
        "molfile string",
    )
    assert [tuple(r) for r in release.drain_structures(raw, keys, "n").collect()] == [
        ("M7", "C", "i", "k", "m")
    ]
