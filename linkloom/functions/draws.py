"""Reproducible random numbers: a hash of the row's key, never ``rand()``.

The same key gives the same number whatever the partitioning, and on a retry.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN, _FINE_SPAN = 4294967296.0, 4503599627370496.0

def _digest(seed: int, keys: tuple[Column, ...]) -> Column:
    return F.md5(F.concat_ws(":", *[k.cast("string") for k in keys], F.lit(str(seed))))


def _unit(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint") / F.lit(_SPAN)


def _fine_unit(digest: Column, start: int = 1) -> Column:
    return F.conv(F.substring(digest, start, 13), 16, 10).cast("bigint") / F.lit(_FINE_SPAN)


def draw(seed: int, *keys: Column) -> Column:
    """Uniform in [0, 1)."""
    return _unit(_digest(seed, keys), 1)


def draw_index(seed: int, n: Column | int, *keys: Column) -> Column:
    """Uniform integer in [0, n), from 52 bits."""
    bound = n if isinstance(n, Column) else F.lit(n)
    return F.floor(_fine_unit(_digest(seed, keys)) * bound).cast("bigint")


def normal(seed: int, *keys: Column) -> Column:
    """Standard normal (Box-Muller), both uniforms from one digest."""
    digest = _digest(seed, keys)
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - _unit(digest, 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _unit(digest, 9))


def fine_draws(seed: int, n: int, *keys: Column) -> Column:
    """``n`` uniforms of 52 bits as an array, for indices; one digest serves two of them."""
    digests = [_digest(seed, (*keys, F.lit(block))) for block in range(-(-n // 2))]
    return F.array(*[_fine_unit(digests[i // 2], 13 * (i % 2) + 1) for i in range(n)])


def driver_draw(seed: int, *keys) -> float:
    """The same uniform for driver-held values such as model weights."""
    text = ":".join([*map(str, keys), str(seed)])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / _SPAN
