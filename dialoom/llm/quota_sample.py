"""Problem 4: a sample that meets target shares of categories (divisor-method priorities).

Every row gets a random rank within its category. With a category's target share t, the row of
rank r has the priority (r - 0.5) / t; rows up to the category's floor come before all others. A
plan keeps the rows of the smallest priorities up to its size. A category that runs out leaves
its seats to the next priorities of the others, without any further rule.

Which priorities are the smallest depends on the number of rows by category only, so the cut is
found on that small table (as many rows as the plans have categories), and the rows themselves
are kept by one comparison of rank and seats: the ranking is made once for all plans, by ranges
of the hash, and no task holds a whole category.

Defined cases: rows with a null or unknown category belong to none and are never drawn; a
repeated id counts once, in the smallest of its known categories; targets whose floors exceed the size keep the floors' smallest
priorities up to the size; an empty table draws nothing and reports all targets; a share of 0
gives only floor rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.operators.ranks import random_rank


def seats(available: list[int], shares: list[float], floors: list[int], size: int) -> list[int]:
    """Rows to keep of each category: the ``size`` smallest priorities, floors first."""
    n = len(available)
    take = [min(a, f) for a, f in zip(available, floors)]
    if sum(take) > size:
        # floors alone exceed the size: their own smallest priorities count
        limits, take = take, [0] * n
    else:
        limits = list(available)
    left = size - sum(take)
    # the priorities below a bound are countable, so a bisection skips almost all of them
    count = lambda x: [min(l, max(t, int(x * s + 0.5))) if s > 0 else t for l, t, s in zip(limits, take, shares)]
    low, high = 0.0, float(size + 1) / max(min([s for s in shares if s > 0], default=1.0), 1e-12)
    if left > 0 and sum(count(high)) - sum(take) > left:
        for _ in range(200):
            mid = (low + high) / 2
            if sum(count(mid)) - sum(take) <= left:
                low = mid
            else:
                high = mid
        got = count(low)
    elif left > 0:
        got = count(high)
    else:
        return take
    left = size - sum(got)
    queue = [((got[i] + 0.5) / shares[i], i) for i in range(n) if got[i] < limits[i] and shares[i] > 0]
    heapq.heapify(queue)
    while left > 0 and queue:
        _, i = heapq.heappop(queue)
        got[i] += 1
        left -= 1
        if got[i] < limits[i]:
            heapq.heappush(queue, ((got[i] + 0.5) / shares[i], i))
    return got


def category_counts(rows: DataFrame, targets: DataFrame, categories: list[str]) -> DataFrame:
    """The targets with ``available``, the number of distinct rows of their category."""
    counts = rows.groupBy(*categories).agg(F.count("*").alias("available"))
    return targets.join(counts, categories, "left").withColumn("available", F.coalesce("available", F.lit(0)))


class Sample:
    """The sample of each plan, and how far it meets the targets."""

    def __init__(
        self, rows: DataFrame, targets: DataFrame, id_col: str, categories: list[str],
        plan: str = "plan_id", share: str = "share", size: str = "sample_size", floor: str = "min_rows", seed: str = "sample",
    ):
        spark = rows.sparkSession
        self.id_col, self.categories, self.plan = id_col, categories, plan
        self.targets = targets = targets.select(plan, *categories, share, size, floor)
        known = rows.select(id_col, *categories).where(F.col(id_col).isNotNull()).join(targets.select(*categories).distinct(), categories, "left_semi")
        one = known.groupBy(F.col(id_col).alias("__id")).agg(F.min(F.struct(*categories)).alias("__c"))
        wanted = one.select(F.col("__id").alias(id_col), *[F.col("__c")[c].alias(c) for c in categories])
        by_plan: dict = {}
        for r in category_counts(wanted, targets, categories).orderBy(plan, *categories).toLocalIterator():
            by_plan.setdefault(r[plan], []).append(r)
        table, largest = [], 1
        for p, rs in by_plan.items():
            got = seats([r.available for r in rs], [float(r[share]) for r in rs], [r[floor] for r in rs], rs[0][size])
            table += [(p, *[r[c] for c in categories], float(r[share]), r[floor], n) for r, n in zip(rs, got)]
            largest = max(largest, *(r.available for r in rs))
        fields = ", ".join([f"{plan} {targets.schema[plan].dataType.simpleString()}", *[f"{c} {targets.schema[c].dataType.simpleString()}" for c in categories], "__t double, __f int, __seats bigint"])
        self.kept = spark.createDataFrame(table, fields)
        self.ranked = random_rank(wanted, categories, [id_col], seed, largest=largest)
        self.need = F.greatest(F.col(share) * F.col(size), F.col(floor).cast("decimal(20,4)"))

    def rows(self) -> DataFrame:
        """``(plan, id, categories..., rank, priority)`` of the sampled rows of each plan."""
        priority = F.when(F.col("rank") <= F.col("__f"), F.lit(0.0)).otherwise((F.col("rank") - 0.5) / F.when(F.col("__t") > 0, F.col("__t")))
        drawn = self.ranked.join(self.kept, self.categories).where("rank <= __seats")
        return drawn.select(self.plan, self.id_col, *self.categories, "rank", priority.alias("priority"))

    def report(self) -> DataFrame:
        """``(plan, categories..., available, needed, drawn)``: a target is met if it has the rows it needs.

        ``available`` is the last rank of the category, ``drawn`` the rows the plan has taken.
        """
        cats = self.categories
        last = self.ranked.groupBy(*cats).agg(F.max("rank").alias("available"))
        seated = self.kept.join(last, cats, "left").select(self.plan, *cats, F.coalesce("available", F.lit(0)).alias("available"), F.least("__seats", F.coalesce("available", F.lit(0))).alias("drawn"))
        need = self.targets.select(self.plan, *cats, self.need.alias("needed"))
        return seated.join(need, [self.plan, *cats]).select(self.plan, *cats, "available", "needed", "drawn")


def shortfalls(rows: DataFrame, targets: DataFrame, id_col: str, categories: list[str], **names: str) -> DataFrame:
    """Targets that the sample cannot meet: their ranks end before the greater of share x size and floor."""
    return Sample(rows, targets, id_col, categories, **names).report().where("available < needed")


def draw(rows: DataFrame, targets: DataFrame, id_col: str, categories: list[str], **names: str) -> DataFrame:
    """``(plan, id, categories..., rank, priority)`` of the sampled rows of each plan."""
    return Sample(rows, targets, id_col, categories, **names).rows()
