"""Feature makers: what a structure is made of, as an array of strings.

All are row-local expressions, linear in the length of the text, and read the whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = " \t\r\n\f"
_SPACES = "[ \\t\\r\\n\\f]+"


def usable(text: Column) -> Column:
    """True when the text has anything to take features from."""
    return F.coalesce(F.trim(text, F.lit(_SPACE)) != "", F.lit(False))


def tokens(text: Column) -> Column:
    """Words between runs of white space."""
    return F.split(F.trim(text, F.lit(_SPACE)), _SPACES)


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row.

    A lambda evaluates whatever it captures for every element, so an array it walks over
    has to reach it as a variable and not as the expression that makes the array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(parts: Column, length: int, glue: str) -> Column:
    """Every run of ``length`` neighbours in an array, or none when it is shorter."""
    joined = F.transform(
        F.sequence(F.lit(0), F.size(parts) - length),
        lambda start: F.concat_ws(glue, *[F.get(parts, start + step) for step in range(length)]),
    )
    return F.when(F.size(parts) >= length, joined).otherwise(F.array().cast("array<string>"))


def ngrams(text: Column, radius: int = 2) -> Column:
    """Each word with its neighbourhoods up to ``radius`` steps: runs of 1 to radius+1 words."""
    sizes = range(2, radius + 2)
    return _once(
        tokens(text), lambda words: F.concat(words, *[_runs(words, n, " ") for n in sizes])
    )


def qgrams(text: Column, q: int = 4) -> Column:
    """Every substring of ``q`` characters; a shorter text is its own only feature.

    The text is split into characters once, because taking a substring by position scans
    from the start each time and would make long texts quadratic.
    """
    trimmed = F.trim(text, F.lit(_SPACE))
    return F.when(
        F.length(trimmed) >= q, _once(F.split(trimmed, ""), lambda letters: _runs(letters, q, ""))
    ).otherwise(F.array(trimmed))


MAKERS: dict[str, Callable[..., Column]] = {
    "tokens": lambda text, radius: tokens(text),
    "ngrams": lambda text, radius: ngrams(text, radius),
    "qgrams": lambda text, radius: qgrams(text, radius + 2),
}


#: Hash families: a feature's number before it is taken modulo the width. The first 32 bits of
#: md5 can be worked out anywhere; xxhash64 (seed 42, as Spark has it) is several times faster.
HASHES: dict[str, Callable[[Column], Column]] = {
    "md5": lambda feature: F.conv(
        F.substring(F.md5(feature.cast("binary")), 1, 8), 16, 10
    ).cast("bigint"),
    "xxhash64": lambda feature: F.xxhash64(feature),
}


def hashed_bits(features: Column, n_bits: int, hashing: str = "md5") -> Column:
    """Distinct bit positions of the features: their hashes modulo ``n_bits``.

    The two families make different libraries: fingerprints of one never fit the other's.
    """
    number = HASHES[hashing]
    return F.array_distinct(
        F.transform(features, lambda feature: F.pmod(number(feature), F.lit(n_bits)).cast("int"))
    )


def sign_bits(vector: Column) -> Column:
    """Positions of the positive elements of a numeric vector."""
    marked = F.transform(vector, lambda value, index: F.when(value > 0, index))
    return F.filter(marked, lambda index: index.isNotNull())
