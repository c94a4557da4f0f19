"""Rows that no later step would keep are left out before they are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.sinks.writers import staged

#: Bits for each key, and the most there are: so many are sent to all tasks.
BITS_PER_KEY, MOST_BITS = 8, 1 << 29
#: Bits of one row of the table, as ``bitmap_construct_agg`` makes them.
ROW_BITS = 1 << 15
#: A key sets one bit from each of these places of its hash on; what is below says in which row.
PLACES = (16, 32)


class KeyBits:
    """Tells rows whose key is not in a set of keys, without a shuffle.

    A key sets two bits in a row of a table that is small enough to be sent to all tasks (a Bloom
    filter).  No row of a key of the set is ever held back.  Some other keys pass too, more of
    them the more keys there are beyond ``most`` bits; what follows has to tell them apart by the
    keys themselves.
    """

    def __init__(self, keys: DataFrame, on: Sequence[str], most: int = MOST_BITS):
        """``keys`` is read twice, so it should be written; keys may repeat."""
        wanted = min(most, max(keys.count() * BITS_PER_KEY, ROW_BITS))
        self.rows = 1 << (wanted // ROW_BITS - 1).bit_length()
        self.kinds = [keys.schema[c].dataType for c in on]
        row, bits = self._place(on)
        places = keys.select(row.alias("_row"), F.explode(F.array(*bits)).alias("_bit"))
        made = places.groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
        self.table = staged(keys.sparkSession, made, "bits")

    def _place(self, on: Sequence[str]) -> tuple[Column, list[Column]]:
        # Numbers of different width have different hashes.
        value = F.xxhash64(*[F.col(c).cast(kind) for c, kind in zip(on, self.kinds, strict=True)])
        bits = [F.shiftrightunsigned(value, n).bitwiseAND(F.lit(ROW_BITS - 1)) for n in PLACES]
        return value.bitwiseAND(F.lit(self.rows - 1)), bits

    def may_hold(self, df: DataFrame, on: Sequence[str]) -> DataFrame:
        """The rows of ``df`` without those whose key is certainly not in the set."""
        row, bits = self._place(on)
        match = row == F.col("_row")
        for bit in bits:
            byte = F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
            number = F.conv(F.hex(byte), 16, 10).cast("int")
            match &= F.bit_get(number, bit.bitwiseAND(F.lit(7)).cast("int")) == 1
        return df.join(F.broadcast(self.table), match, "left_semi")
