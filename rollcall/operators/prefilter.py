"""Leaving out rows of a big side whose keys can't meet a small side.

The small side's keys are hashed into ``SLOTS`` slots. The set of used slots,
at most ``SLOTS`` numbers whatever the data, is broadcast, and rows of the big side
in other slots go before they are shuffled. Rows of used slots stay, also those
that merely share one, so the exact join must follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 20

SLOT = "_slot"


def near(big: DataFrame, small: DataFrame, keys: list[str], slots: int = SLOTS) -> DataFrame:
    """Rows of ``big`` whose keys share a slot with a key of ``small``."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots)).alias(SLOT)
    used = F.broadcast(small.select(slot).distinct())
    return big.withColumn(SLOT, slot).join(used, SLOT, "left_semi").drop(SLOT)
