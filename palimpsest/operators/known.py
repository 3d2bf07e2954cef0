"""Which records are new, against a set of known ids of any size.

A bitmap with a bit for each known id's hash is sent to every task; a record whose bit is clear is new without
further ado and stays where it is. Only records whose bit is set, the known ones and a few that share a bit with one,
are shuffled to the exact anti-join. The bitmap has a size limit; above it more bits are shared and more records
take the exact way, to the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palimpsest.session import stored

#: Bits of one row of a bitmap, as Spark's bitmap functions lay it out.
ROW_BITS = 32_768
#: Bits per known id that the bitmap is made for, and the most it has in all: 32 MB.
BITS_PER_ID = 10
MOST_BITS = 1 << 28


def bits_for(ids: int) -> int:
    """Size of the bitmap for so many ids."""
    bits = ROW_BITS
    while bits < BITS_PER_ID * ids and bits < MOST_BITS:
        bits *= 2
    return bits


def place(key: Column, bits: int) -> Column:
    """The id's bit, from 1 on."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(bits)) + 1


def bitmap(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """(row, bits) of the ids' bitmap: partial bitmaps where the ids are read, at most bits / 32,768 rows after."""
    at = ids.where(F.col(key).isNotNull()).select(place(F.col(key), bits).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )


def is_set(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap row is set."""
    octet = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return octet.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0


def with_suspicion(records: DataFrame, known: DataFrame, key: str, bits: int) -> DataFrame:
    """``records`` with ``_suspected``: whether the id's bit is set among those of ``known``."""
    rows = stored(bitmap(known, key, bits), "bitmap")
    at = place(F.col(key), bits)
    marked = records.withColumn("_row", F.bitmap_bucket_number(at))
    met = marked.join(F.broadcast(rows.withColumnRenamed("row", "_row").withColumnRenamed("bits", "_bits")), "_row", "left")
    found = F.coalesce(is_set(F.col("_bits"), F.bitmap_bit_position(at)), F.lit(False))
    return met.withColumn("_suspected", found).drop("_row", "_bits")


def unknown(records: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Records whose id is not among the known ones; without an id they match none.

    ``records`` is read twice, as table scans are; ``known`` is counted, mapped and, for the suspects, joined.
    """
    known = known.select(F.col(key).cast(records.schema[key].dataType).alias(key))
    marked = with_suspicion(records, known, key, bits_for(known.count()))
    clear = marked.where(~F.col("_suspected")).drop("_suspected")
    suspects = marked.where("_suspected").drop("_suspected")
    return clear.unionByName(suspects.join(known, key, "left_anti").select(clear.columns))
