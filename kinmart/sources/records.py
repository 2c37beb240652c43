"""Nested JSON records to flat bronze tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmart.schemas import (
    COMPOUND_PROPERTIES,
    COMPOUND_STRUCTURES,
    ID_LOOKUP,
    KEY,
    MOLECULE_DICTIONARY,
)


@dataclass(frozen=True)
class MoleculeLayout:
    """Names under which a molecule record carries its identifier and sub-documents."""

    id_field: str = KEY
    properties_field: str = "molecule_properties"
    structures_field: str = "molecule_structures"


def _parse(text: Column, schema: T.StructType, mode: str) -> Column:
    return F.from_json(text, schema, {"mode": mode})


def _filled(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def _renamed(schema: T.StructType, id_field: str) -> T.StructType:
    rest = [field for field in schema.fields if field.name != KEY]
    return T.StructType([T.StructField(id_field, T.StringType()), *rest])


def lookup_rows(
    records: DataFrame,
    column: str = "record",
    mode: str = "FAILFAST",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Identifier lookup rows; a record whose identifier is missing or empty is skipped."""
    parsed = records.select(_parse(F.col(column), ID_LOOKUP, mode).alias("r"), *keep)
    parsed = parsed.select("r.*", *keep)
    return parsed.where(_filled(F.col(KEY)))


@dataclass(frozen=True)
class MoleculeTables:
    """The three bronze tables one stream of molecule records feeds."""

    dictionary: DataFrame
    properties: DataFrame
    structures: DataFrame


def molecule_tables(
    records: DataFrame,
    column: str = "record",
    layout: MoleculeLayout = MoleculeLayout(),
    mode: str = "FAILFAST",
    keep: tuple[str, ...] = (),
) -> MoleculeTables:
    """Split molecule records into dictionary, properties and structures.

    A sub-document that is absent, null or empty gives no row; one whose fields are all null
    gives a row. Each table parses only the fields it needs. ``keep`` names further columns
    of ``records`` to carry along, such as the position of a record.
    """
    extra = [F.col(name) for name in keep]

    def part(fields: T.StructType) -> DataFrame:
        parsed = _parse(F.col(column), _renamed(fields, layout.id_field), mode)
        frame = records.select(parsed.alias("r"), *extra)
        return frame.where(_filled(F.col(f"r.{layout.id_field}")))

    def sub_document(field: str, schema: T.StructType) -> DataFrame:
        # Read as text first: a parsed empty object cannot be told from one of nulls.
        frame = part(T.StructType([T.StructField(field, T.StringType())]))
        text = F.col(f"r.{field}")
        inner = T.StructType([f for f in schema.fields if f.name != KEY])
        held = frame.where(~text.isin("{}", "[]", "", "false", "0"))
        return held.select(
            F.col(f"r.{layout.id_field}").alias(KEY), _parse(text, inner, mode).alias("s"), *extra
        ).select(KEY, "s.*", *extra)

    dictionary = part(MOLECULE_DICTIONARY).select("r.*", *extra)
    return MoleculeTables(
        dictionary=dictionary.withColumnRenamed(layout.id_field, KEY),
        properties=sub_document(layout.properties_field, COMPOUND_PROPERTIES),
        structures=sub_document(layout.structures_field, COMPOUND_STRUCTURES),
    )
