"""Random ranks within groups, exact also for groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the largest group that one range of the hash holds, about.
RANGE_ROWS = 1 << 18


def random_rank(
    df: DataFrame, keys: list[str], id_cols: list[str], salt: str, out: str = "rank", largest: int = 1 << 26, hex_order: Column | None = None
) -> DataFrame:
    """``df`` with ``out``: 1, 2, ... within ``keys`` in the order of a hash of salt and ids.

    A group is cut into ranges of the hash; each range is ranked on its own and shifted by the
    number of rows in the ranges before it, so no task sorts a whole group. Equal hashes fall
    back on the ids. The same salt gives the same ranks on every run and partitioning. The number
    of ranges follows ``largest``, the size of the largest group as far as the caller knows it:
    a range holds about ``RANGE_ROWS`` rows of such a group. With ``hex_order``, the hash is this
    column of hexadecimal digits (an MD5, say) and the ranges are its first digits.
    """
    buckets_log2 = max(6, (-(-largest // RANGE_ROWS) - 1).bit_length())
    digits = max(2, -(-buckets_log2 // 4))
    h, bucket, before = "__hash", "__bucket", "__before"
    if hex_order is None:
        hashed = df.withColumn(h, F.xxhash64(F.lit(salt), *[F.col(c) for c in id_cols])).withColumn(bucket, F.shiftright(h, 64 - buckets_log2).cast("int"))
    else:
        hashed = df.withColumn(h, hex_order).withColumn(bucket, F.conv(F.substring(h, 1, digits), 16, 10).cast("int"))
    counts = hashed.groupBy(*keys, bucket).agg(F.count("*").alias("__n"))
    so_far = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*keys, bucket, F.coalesce(F.sum("__n").over(so_far), F.lit(0)).alias(before))
    own = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(h, *id_cols))
    ranked = hashed.withColumn(out, own).alias("r")
    same = F.col(f"r.{bucket}") == F.col(f"s.{bucket}")
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    joined = ranked.join(shift.alias("s"), same)
    return joined.select(*[F.col(f"r.{c}") for c in df.columns if c != out], (F.col(f"r.{out}") + F.col(before)).alias(out))
