"""Sizes and parameters of one mart."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Parameters that decide what is computed, plus two that bound memory.

    ``sources_per_pass`` bounds what is broadcast while scoring: one pass carries at most
    that many source fingerprints, and a larger source set takes further passes over the
    library rather than a larger broadcast.
    """

    radius: int = 2
    n_bits: int = 2048
    shard_size: int = 250_000
    target_size: int = 100
    top_n: int = 10
    pivot_sources: int = 10
    sources_per_pass: int = 4096
    hashing: str = "md5"

    def __post_init__(self) -> None:
        if self.n_bits <= 0 or self.n_bits % 8:
            raise ValueError(f"n_bits must be a positive multiple of 8, got {self.n_bits}")
        for name in ("shard_size", "top_n", "pivot_sources", "sources_per_pass"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1, got {getattr(self, name)}")
        if self.hashing not in ("md5", "xxhash64"):
            raise ValueError(f"hashing must be md5 or xxhash64, got {self.hashing}")
        if self.radius < 0 or self.target_size < 0:
            raise ValueError("radius and target_size must not be negative")

    @property
    def n_words(self) -> int:
        """64-bit words that hold one fingerprint."""
        return (self.n_bits + 63) // 64

    @property
    def n_bytes(self) -> int:
        """Width of one fingerprint in the packed byte layout."""
        return self.n_bits // 8
