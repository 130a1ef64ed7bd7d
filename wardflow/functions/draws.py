"""Reproducible draws: a row's fate depends on its key and a seed only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE = 10_000


def draw(key: Column, seed: int) -> Column:
    """Integer in [0, 10000) fixed by key and seed, the same on any engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(SCALE))


def chosen(key: Column, seed: int, rate: float) -> Column:
    """Whether the row falls in a sample holding ``rate`` of all rows."""
    return draw(key, seed) < F.lit(round(rate * SCALE))
