"""Draws without random state: pure functions of a seed and a stable key, the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_order(seed: int, *key: Column | str) -> Column:
    """A string to order by: md5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in key]))


def uniform(seed: int, *key: Column | str) -> Column:
    """A number in [0, 1): the first 32 bits of hash_order."""
    return F.conv(F.substring(hash_order(seed, *key), 1, 8), 16, 10).cast("double") / float(1 << 32)


def pick(seed: int, options: list[str], *key: Column | str) -> Column:
    """One of the options, evenly; an option listed more often comes more often."""
    return F.element_at(F.array(*map(F.lit, options)), F.floor(uniform(seed, *key) * len(options)).cast("int") + 1)
