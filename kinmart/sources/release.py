"""Tables of a full release to bronze: casts, flags, and natural for surrogate keys.

Each function takes any frame with the release's columns: a parquet copy, or
``spark.read.jdbc`` split on the surrogate key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmart.functions.casts import is_one, rounded_int
from kinmart.schemas import (
    COMPOUND_PROPERTIES,
    COMPOUND_STRUCTURES,
    ID_LOOKUP,
    KEY,
    MOLECULE_DICTIONARY,
)


def _drain(raw: DataFrame, schema: T.StructType, absent: tuple[str, ...] = ()) -> DataFrame:
    """Cast every column to its bronze type; ``absent`` ones become typed nulls."""
    columns = []
    for field in schema.fields:
        column, kind = F.col(field.name), field.dataType
        if field.name in absent:
            made = F.lit(None).cast(kind)
        elif isinstance(kind, T.BooleanType):
            made = is_one(column)
        elif isinstance(kind, (T.IntegerType, T.LongType)):
            made = rounded_int(column, kind.simpleString())
        else:
            made = column.cast(kind)
        columns.append(made.alias(field.name))
    return raw.select(*columns)


def key_map(raw_dictionary: DataFrame, surrogate: str) -> DataFrame:
    """Surrogate to natural key, for the tables that only know the surrogate."""
    return raw_dictionary.select(surrogate, KEY)


def drain_dictionary(raw: DataFrame) -> DataFrame:
    """Dictionary rows: 0/1 numbers become flags. A release has no helm notation here."""
    return _drain(raw, MOLECULE_DICTIONARY, absent=("helm_notation",))


def drain_properties(raw: DataFrame, keys: DataFrame, surrogate: str) -> DataFrame:
    """Property rows under their natural key, decimals as text."""
    return _drain(raw.join(keys, surrogate), COMPOUND_PROPERTIES)


def drain_structures(raw: DataFrame, keys: DataFrame, surrogate: str) -> DataFrame:
    """Structure rows under their natural key."""
    return _drain(raw.join(keys, surrogate), COMPOUND_STRUCTURES)


def drain_lookup(raw: DataFrame) -> DataFrame:
    """Lookup rows. Only the record route knows a resource_url."""
    return _drain(raw, ID_LOOKUP, absent=("resource_url",))
