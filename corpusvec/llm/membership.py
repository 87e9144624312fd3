"""Sort out the few rows whose id is in a table, without moving the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusvec.llm.common import unused

#: Bits of the table of hashed ids, which is sent to every task: 4 MB, however
#: many ids there are. With very many the test lets more rows pass, no fewer.
BITS = 1 << 25


def hashed(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(BITS)) + 1


def split_by(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``docs`` in two: rows whose id may be in ``ids`` (its first column), and rows whose id is not.

    The first part still needs a join for the exact answer, but is about as
    small as ``ids``; the second needs none, so its texts stay where they are.
    A null id is in the second part.
    """
    place, bucket, bits, byte = (unused(n, docs.columns) for n in ("_place", "_bucket", "_bits", "_byte"))
    sent = (
        ids.select(hashed(F.col(ids.columns[0])).alias(place))
        .groupBy(F.bitmap_bucket_number(place).alias(bucket))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bits))
    )
    own = docs.withColumn(place, hashed(F.col(f"`{key}`")))
    own = own.withColumn(bucket, F.bitmap_bucket_number(place)).join(F.broadcast(sent), bucket, "left")
    position = F.bitmap_bit_position(place)
    own = own.withColumn(byte, F.conv(F.hex(F.substring(F.col(bits), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int"))
    # shiftright takes a plain number only.
    is_set = F.expr(f"shiftright({byte}, cast(bitmap_bit_position({place}) % 8 as int)) & 1") == 1
    maybe = F.col(f"`{key}`").isNotNull() & F.coalesce(is_set, F.lit(False))
    parts = (own.where(maybe), own.where(~maybe))
    return tuple(p.drop(place, bucket, bits, byte) for p in parts)
