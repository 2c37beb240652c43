"""Casts and text predicates. Every function takes and returns columns."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: what counts as a plain number. try_cast alone also takes "+5", ".5" and "5.".
PLAIN_NUMBER = r"^\s*-?\d+(\.\d+)?([eE][-+]?\d+)?\s*$"


def safe_decimal(text: Column, kind: str = "decimal(28,8)") -> Column:
    """A decimal when ``text`` is a plain number that fits ``kind``, else null. Never raises."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast(kind))


def register_safe_numeric(spark: SparkSession, name: str = "safe_numeric") -> None:
    """Make the same cast callable from SQL text in this session."""
    pattern = PLAIN_NUMBER.replace("\\", "\\\\")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS DECIMAL(28,8) "
        f"RETURN CASE WHEN value RLIKE '{pattern}' THEN try_cast(value AS DECIMAL(28,8)) END"
    )


def rounded_int(number: Column, kind: str = "int") -> Column:
    """Number to integer, rounding halves away from zero where a plain cast would truncate."""
    return F.round(number).cast(kind)


def yes_no(text: Column) -> Column:
    """Y and N in either case to a boolean; anything else is null."""
    return F.when(F.upper(text) == "Y", True).when(F.upper(text) == "N", False)


def is_one(number: Column) -> Column:
    """A 0/1 number to a boolean; null stays null."""
    return number == 1


def is_blank(text: Column) -> Column:
    """Null, empty or spaces only."""
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def match_name(text: Column) -> Column:
    """The form under which a delivered name is looked up."""
    return F.upper(F.trim(text))
