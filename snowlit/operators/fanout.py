"""Every row of a large table with every row of a small one, without a cross join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 64


def fan_out(
    large: DataFrame, small: DataFrame, keys: Sequence[str], slots: int = SLOTS
) -> DataFrame:
    """Equi-join on a slot number: ``large`` rows are dealt into slots by a hash of
    ``keys``, which tell rows apart; ``small`` is repeated once per slot. If ``small``
    is under the broadcast threshold nothing is shuffled; if not, the work still
    spreads over the slots.
    """
    dealt = large.withColumn("_slot", F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))
    copies = small.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return dealt.join(copies, "_slot").drop("_slot")
