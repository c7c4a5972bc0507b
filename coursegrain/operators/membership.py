"""A set of values as bits: small, of a fixed size, and never wrong about what it holds.

Where a join would shuffle a large table only to drop most of it, the small side's
keys become a bitmap of their hashes, which is a constant in the scan of the large
side. A value that was put in is always found; another one is found with the
probability of the share of bits that are set, so that an exact step has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 1 << 14, 1 << 22


class Bitmap:
    """Bits of a set, as a constant for expressions."""

    def __init__(self, words: dict[int, int], bits: int) -> None:
        listed = ",".join(str(words.get(i, 0)) for i in range(bits // 64))
        # Spelt out, as a long literal array would be built number by number.
        self._held, self.bits = F.split(F.lit(listed), ",").cast("array<bigint>"), bits

    def might_hold(self, value: Column) -> Column:
        """Whether the set may have the value; false is certain."""
        slot = F.pmod(F.xxhash64(value), F.lit(self.bits))
        word = F.get(self._held, (slot / 64).cast("int"))
        return F.call_function("shiftright", word, (slot % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def bitmap(values: DataFrame, column: str, bits: int | None = None) -> Bitmap:
    """The present values of a column. Bits are combined in the map tasks, and what comes
    to the driver has the size of the bitmap, ``MOST_BITS`` at most, however many values
    there are. Without ``bits`` there are about a hundred for each row."""
    if bits is None:
        wanted = 100 * values.count()
        bits = min(max(1 << wanted.bit_length(), LEAST_BITS), MOST_BITS)
    slot = F.pmod(F.xxhash64(F.col(column)), F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    words = (
        values.where(F.col(column).isNotNull())
        .select(slot.alias("slot"))
        .groupBy((F.col("slot") / 64).cast("int").alias("word"))
        .agg(F.bit_or(one).alias("held"))
    )
    return Bitmap(dict(tuple(r) for r in words.collect()), bits)
