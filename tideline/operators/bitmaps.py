"""A bounded filter of keys that every task can hold, to spare rows a shuffle.

Keys are marked in a bitmap of fixed size, cut into rows of 4 KB: at most ``bits / 32768`` of them
(1 MB with the default), whatever the number of keys. A row whose bit is not set has no such key; a
row whose bit is set goes through the exact join. A crowded bitmap costs time, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23
_ROW_BITS = 32768


def _slot(keys: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def bitmap(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """Bitmap of the rows of ``keys`` over all its columns."""
    slot = _slot([F.col(f"`{c}`") for c in keys.columns], bits)
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.floor(F.col("slot") / _ROW_BITS).cast("int").alias("_bm_row"))
        .agg(F.bitmap_construct_agg(F.col("slot") % _ROW_BITS).alias("_bm_bits"))
    )


def marked(df: DataFrame, bitmap: DataFrame, keys: list[Column], flag: str, bits: int = BITS) -> DataFrame:
    """``df`` with ``flag``: whether its keys may be in the bitmap (false is certain)."""
    spot = (F.col("_bm_slot") % _ROW_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bm_bits"), F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.try_element_at(
        F.array(*[F.expr(f"shiftright(cast(_bm_byte as int), {i}) & 1") for i in range(8)]), spot % 8 + 1
    )
    return (
        df.withColumn("_bm_slot", _slot(keys, bits))
        .withColumn("_bm_row", F.floor(F.col("_bm_slot") / _ROW_BITS).cast("int"))
        .join(F.broadcast(bitmap), "_bm_row", "left")
        .withColumn("_bm_byte", byte)
        .withColumn(flag, F.coalesce(bit == 1, F.lit(False)))
        .drop("_bm_slot", "_bm_row", "_bm_bits", "_bm_byte")
    )
