"""Arithmetic on fingerprints held as an array of 64-bit words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def popcount(words: Column) -> Column:
    """Bits set over all words."""
    return F.aggregate(words, F.lit(0), lambda total, word: total + F.bit_count(word))


def shared_bits(a: Column, b: Column) -> Column:
    """Bits set in both fingerprints."""
    return popcount(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared bits over bits in either, as a double; zero when neither has a bit."""
    shared = shared_bits(a, b)
    union = popcount(a) + popcount(b) - shared
    return F.when(union > 0, shared.cast("double") / union).otherwise(F.lit(0.0))
