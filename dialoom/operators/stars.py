"""Classes of rows that meet in buckets, without the pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.session import Scratch


def bucket_links(members: DataFrame, verify: Callable[[DataFrame], DataFrame], scratch: Scratch) -> DataFrame:
    """From (x, band) links (x, y, ...) whose components are those of all true links within bands.

    ``verify`` gets candidates (x, y), x < y, and gives the true ones, with columns of its own.
    A bucket of n rows costs n candidates first: every row with the smallest one. Rows linked to
    the same one, or to ones so linked, are one class. Only where a bucket still holds several classes are the rows outside its
    largest class compared with those of other classes: every link that joins two classes is
    looked at, and rows that are all alike make no pairs, however many they are.
    """
    centre = members.groupBy("band").agg(F.min("x").alias("centre"), F.count("*").alias("n")).where("n > 1")
    centre = scratch.table(centre.select("band", "centre"))
    star = members.join(centre, "band").where("x <> centre").select(F.col("centre").alias("x"), F.col("x").alias("y")).distinct()
    star = scratch.table(star)
    first = verify(star)
    nearest = first.groupBy(F.col("y").alias("x")).agg(F.min(F.least("x", "y")).alias("to"))
    further = nearest.select(F.col("x").alias("to"), F.col("to").alias("root"))
    class_of = nearest.join(further, "to", "left").select("x", F.coalesce("root", "to").alias("c"))
    tagged = members.join(centre.select("band"), "band", "left_semi").join(class_of, "x", "left").select("band", "x", F.coalesce("c", "x").alias("c"))
    tagged = scratch.table(tagged)
    by_class = tagged.groupBy("band", "c").agg(F.count("*").alias("n"))
    mixed = by_class.groupBy("band").agg(F.max_by("c", F.struct("n", "c")).alias("big"), F.count("*").alias("classes")).where("classes > 1").select("band", "big")
    inside = tagged.join(mixed, "band")
    outside = inside.where("c <> big").select("band", F.col("x").alias("y"), F.col("c").alias("d"))
    across = inside.select("band", "x", "c").join(outside, "band").where("c <> d").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    second = verify(across.join(star, ["x", "y"], "left_anti"))
    return first.unionByName(second)
