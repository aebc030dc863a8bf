"""Problem 1: splits that keep linked records together (min-cost flow allocation).

``linked_groups`` gives each record the group of records it shares a key with, also by way of
others: distinct pairs of keys, then connected components.

``split_groups`` assigns whole groups to splits:

1. Groups of the same size and label profile are one bundle. The profile counts the records of
   each label: exactly in groups of up to ``EXACT_PROFILE`` records, in shares of eighths in
   larger ones; sizes are exact up to ``EXACT_SIZE`` and in steps of a thirty-second above.
   Labels beyond the ``labels`` most frequent ones count as one. So the driver sees a number of
   bundles that depends on the number of labels and the logarithm of the largest group, not on
   the number of records (with five labels at most about 300,000).
2. One min-cost flow sends the records of all bundles through quotas of (split, profile) and of
   the splits. A record above a quota costs, and so does a group that is large for a split's
   quota, in proportion: such groups go where they disturb least.
3. The flow is rounded to whole groups, largest first, each remainder where the groups so far
   have fallen behind the flow most, in records and in records of each label; then groups move,
   or change places with groups of nearly their size, as long as that brings splits and labels
   nearer to their quotas.
4. The members of a bundle are dealt by the rank of a hash.

Defined cases: a record without any key is a group of its own; null keys link nothing; repeated
record ids count once, and all their keys link; an empty table gives an empty result. A group
larger than every quota goes where the deviation is least. Proportions must be positive and are
normalised. Null labels are a label.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators.components import connected_components
from dialoom.operators.ranks import random_rank
from dialoom.session import Scratch

#: Sizes and profiles that are told apart exactly; steps of the larger ones.
EXACT_SIZE, SIZE_STEPS, EXACT_PROFILE, SHARES = 64, 32, 8, 8
#: Costs of a record above a split's and above a (split, profile)'s quota; from which share of a split's quota on a group costs by its size.
OVER_SPLIT, OVER_CELL, LARGE = 300, 100, 0.05
#: Bundles next in size with which a bundle may exchange groups after the rounding.
SWAPS = 24


def linked_groups(records: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """``(<id_col>, component)``; the component is the smallest tagged key of the group."""
    tagged: list[Column] = [F.when(F.col(k).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(k).cast("string"))) for i, k in enumerate(keys)]
    rows = records.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.array_compact(F.array(*tagged)).alias("ks"), F.concat(F.lit("~:"), F.col(id_col).cast("string")).alias("own")
    )
    # every record hangs on its first key; a record without keys has one of its own
    rows = rows.withColumn("first", F.coalesce(F.try_element_at("ks", F.lit(1)), "own"))
    edges = rows.select("first", F.explode(F.when(F.size("ks") > 0, F.col("ks")).otherwise(F.array("own"))).alias("k"))
    # records that come several times with different keys: every row is linked to the id's smallest key
    spans = rows.groupBy("id").agg(F.min("first").alias("low"), F.max("first").alias("high")).where("low <> high")
    again = rows.join(spans, "id").select("first", F.col("low").alias("k"))
    groups = connected_components(edges.union(again), "first", "k")
    first = rows.groupBy("id").agg(F.min("first").alias("node"))
    return first.join(groups, "node").select(F.col("id").alias(id_col), "component")


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of a cheapest largest flow.

    Primal-dual: shortest distances by reduced costs, then as much flow as the arcs on shortest
    paths take, so the rounds are as many as there are different costs of paths.
    """
    head: list[list[int]] = [[] for _ in range(n)]
    to, cap, cost = [], [], []
    for a, b, c, w in arcs:
        for x, y, cc, ww in ((a, b, c, w), (b, a, 0, -w)):
            head[x].append(len(to))
            to.append(y)
            cap.append(cc)
            cost.append(ww)
    price = [0] * n
    far = float("inf")
    while True:
        dist: list[float] = [far] * n
        dist[source] = 0
        heap = [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > dist[x]:
                continue
            for e in head[x]:
                if cap[e]:
                    y = to[e]
                    nd = d + cost[e] + price[x] - price[y]
                    if nd < dist[y]:
                        dist[y] = nd
                        heapq.heappush(heap, (nd, y))
        if dist[sink] == far:
            return [cap[2 * i + 1] for i in range(len(arcs))]
        for x in range(n):
            price[x] += int(min(dist[x], dist[sink]))
        # paths of reduced cost 0, in layers by the number of arcs, until none is left
        while True:
            level = [-1] * n
            level[source] = 0
            queue = [source]
            for x in queue:
                for e in head[x]:
                    y = to[e]
                    if cap[e] and level[y] < 0 and cost[e] + price[x] - price[y] == 0:
                        level[y] = level[x] + 1
                        queue.append(y)
            if level[sink] < 0:
                break
            at = [0] * n
            path: list[int] = []
            x = source
            while True:
                if x == sink:
                    push = min(cap[e] for e in path)
                    for e in path:
                        cap[e] -= push
                        cap[e ^ 1] += push
                    cut = next(k for k, e in enumerate(path) if not cap[e])
                    x = to[path[cut] ^ 1]
                    del path[cut:]
                while at[x] < len(head[x]):
                    e = head[x][at[x]]
                    y = to[e]
                    if cap[e] and level[y] == level[x] + 1 and cost[e] + price[x] - price[y] == 0:
                        break
                    at[x] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    x = to[e ^ 1]
                    at[x] += 1
                    continue
                path.append(e)
                x = y


def _quotas(total: int, proportions: list[float]) -> list[int]:
    exact = [total * p for p in proportions]
    out = [int(x) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: out[i] - exact[i])[: total - sum(out)]:
        out[i] += 1
    return out


@dataclass
class Bundle:
    """Groups of one size and label profile: how many, their records, and these by label."""

    groups: int
    records: int
    by_label: tuple[int, ...]

    @property
    def size(self) -> float:
        return self.records / self.groups

    def shape(self) -> tuple[int, ...]:
        """The profile in shares of eighths."""
        return tuple(round(SHARES * n / max(1, self.records)) for n in self.by_label)


def _flows(bundles: list[Bundle], p: list[float]) -> np.ndarray:
    """Records of each bundle for each split: the cheapest flow through all quotas.

    Bundles of one shape whose groups are small for every split have equal arcs without cost, so
    they are one node of the network; their flow is theirs in proportion to their records.
    """
    k = len(p)
    quota = _quotas(sum(b.records for b in bundles), p)
    shapes: dict[tuple[int, ...], int] = {}
    of = [shapes.setdefault(b.shape(), len(shapes)) for b in bundles]
    large = [i for i, b in enumerate(bundles) if b.size > LARGE * max(1, min(quota))]
    total = [0] * len(shapes)
    for s, b in zip(of, bundles):
        total[s] += b.records
    pooled = list(total)
    for i in large:
        pooled[of[i]] -= bundles[i].records
    # nodes: source, large bundles, pools of shapes, (shape, split), splits, sink
    pool = 1 + len(large)
    cell = pool + len(shapes)
    split = cell + k * len(shapes)
    sink = split + k
    much = sum(total)
    arcs: list[tuple[int, int, int, int]] = []
    for x, i in enumerate(large):
        arcs.append((0, 1 + x, bundles[i].records, 0))
        arcs += [(1 + x, cell + of[i] * k + j, bundles[i].records, int(OVER_CELL * bundles[i].size / q) if bundles[i].size > LARGE * q else 0) for j, q in enumerate(max(1, v) for v in quota)]
    for s, n in enumerate(pooled):
        arcs.append((0, pool + s, n, 0))
        arcs += [(pool + s, cell + s * k + j, n, 0) for j in range(k)]
    for s, n in enumerate(total):
        for j, q in enumerate(_quotas(n, p)):
            arcs += [(cell + s * k + j, split + j, q, 0), (cell + s * k + j, split + j, much, OVER_CELL)]
    for j in range(k):
        arcs += [(split + j, sink, quota[j], 0), (split + j, sink, much, OVER_SPLIT)]
    flow = min_cost_flow(sink + 1, arcs, 0, sink)
    out = np.zeros((len(bundles), k))
    for x, i in enumerate(large):
        out[i] = flow[x * (k + 1) + 1 : (x + 1) * (k + 1)]
    first = len(large) * (k + 1)
    of_pool = np.array([flow[first + s * (k + 1) + 1 : first + (s + 1) * (k + 1)] for s in range(len(shapes))], float).reshape(-1, k)
    share = of_pool / np.maximum(1, of_pool.sum(1, keepdims=True))
    small = np.ones(len(bundles), bool)
    small[large] = False
    out[small] = share[np.array(of)[small]] * np.array([b.records for b in bundles], float)[small, None]
    return out


def allocate(bundles: list[Bundle], proportions: list[float], moves: int = 1000) -> np.ndarray:
    """For each bundle the number of its groups for each split."""
    p = [x / sum(proportions) for x in proportions]
    k = len(p)
    flows = _flows(bundles, p)
    size = np.array([b.size for b in bundles])
    groups = np.array([b.groups for b in bundles])
    mix = np.array([b.by_label for b in bundles], float) / groups[:, None]  # records of each label in a group
    take = np.minimum(np.floor(flows / size[:, None] + 1e-9), groups[:, None]).astype(np.int64)
    behind, by_label = [0.0] * k, np.zeros((k, mix.shape[1]))
    for i in np.argsort(-size, kind="stable"):
        f, t, s = flows[i].tolist(), take[i].tolist(), float(size[i])
        m = mix[i]
        for j in range(k):
            behind[j] += f[j] - t[j] * s
            by_label[j] += m * (f[j] / s - t[j])
        for _ in range(int(groups[i]) - sum(t)):
            w = by_label @ m / s
            j = max(range(k), key=lambda j: 3 * min(behind[j] - s, 0) + behind[j] + w[j])
            take[i, j] += 1
            behind[j] -= s
            by_label[j] -= m
    # what is still missing, of records and of each label; groups move while that makes it less
    quota = np.array(p) * sum(b.records for b in bundles)
    of_label = np.array(p)[:, None] * np.array([b.by_label for b in bundles]).sum(0)
    wide = np.column_stack([3 * size, mix])
    gone = np.column_stack([3 * quota, of_label]) - take.T @ wide
    by_size = np.argsort(size, kind="stable")
    for _ in range(moves):
        if np.abs(gone).sum() <= 1e-5 * quota.sum():
            break
        best, what = 1e-9, None
        # one group from a to b; or in exchange for another one of nearly its size
        for shift in range(min(SWAPS + 1, len(by_size))):
            x = by_size[: len(by_size) - shift]
            for i, h in ((x, None),) if not shift else ((x, by_size[shift:]), (by_size[shift:], x)):
                change = wide[i] if h is None else wide[i] - wide[h]
                may = np.abs(change[:, 0]) <= 2 * np.abs(gone).max()
                i, h, change = i[may], None if h is None else h[may], change[may]
                if not len(i):
                    continue
                for a in range(k):
                    for b in range(k):
                        if a != b:
                            gain = np.abs(gone[a]).sum() + np.abs(gone[b]).sum() - (np.abs(gone[a] + change) + np.abs(gone[b] - change)).sum(1)
                            gain[(take[i, a] < 1) | (False if h is None else take[h, b] < 1)] = -1
                            at = int(gain.argmax())
                            if gain[at] > best:
                                best, what = gain[at], (int(i[at]), None if h is None else int(h[at]), a, b, change[at])
            if shift == 0 and what is not None:
                break
        if what is None:
            break
        i, h, a, b, change = what
        for x, a, b in ((i, what[2], what[3]), (h, what[3], what[2])):
            if x is not None:
                take[x, a] -= 1
                take[x, b] += 1
        gone[what[2]] += change
        gone[what[3]] -= change
    return take


def split_groups(
    grouped: DataFrame,
    id_col: str,
    group: str = "component",
    label: str | None = None,
    splits: dict[str, float] | None = None,
    seed: str = "splits",
    labels: int = 5,
) -> DataFrame:
    """``(<id_col>, <group>, split)``: each record with the split of its group."""
    spark: SparkSession = grouped.sparkSession
    splits = splits or {"train": 0.8, "validation": 0.1, "test": 0.1}
    if min(splits.values()) <= 0:
        raise ValueError("proportions must be positive")
    names = list(splits)
    lab = F.coalesce(F.col(label).cast("string"), F.lit("")) if label else F.lit("")
    rows = grouped.select(F.col(id_col).alias("id"), F.col(group).alias("g"), lab.alias("l"))
    counted = rows.groupBy("g", "l").agg(F.count("*").alias("n"))
    if label:
        counted = Scratch(spark, "splits").table(counted)
        frequent = [r.l for r in counted.groupBy("l").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "l").take(labels)]
    else:
        frequent = [""]
    kinds = [F.sum(F.when(F.col("l") == x, F.col("n")).otherwise(0)).alias(f"c{i}") for i, x in enumerate(frequent)]
    cs = [f"c{i}" for i in range(len(frequent))]
    profile = counted.groupBy("g").agg(F.sum("n").alias("size"), *kinds)
    step = F.when(F.col("size") <= EXACT_SIZE, F.col("size")).otherwise((EXACT_SIZE + F.log(F.col("size") / EXACT_SIZE) * SIZE_STEPS).cast("bigint"))
    shares = [F.when(F.col("size") <= EXACT_PROFILE, F.col(c)).otherwise(F.round(F.col(c) * SHARES / F.col("size")).cast("bigint")) for c in cs]
    profile = profile.withColumn("bundle", F.concat_ws("/", step, *shares))
    profile = Scratch(spark, "splits").table(profile)  # one row per group, read twice
    total = profile.groupBy("bundle").agg(F.count("*").alias("groups"), F.sum("size").alias("size"), *[F.sum(c).alias(c) for c in cs])
    found = total.orderBy("bundle").toPandas()
    bundles = [Bundle(int(n), int(s), (*map(int, c), int(s) - sum(map(int, c)))) for n, s, *c in found[["groups", "size", *cs]].itertuples(index=False)]
    shares_of = allocate(bundles, [splits[x] for x in names]) if bundles else []
    cuts = []
    for name_of, take in zip(found["bundle"], shares_of):
        low = 0
        for name, n in zip(names, take.tolist()):
            if n:
                cuts.append((name_of, low + 1, low + n, name))
            low += n
    plan = spark.createDataFrame(cuts, "bundle string, low bigint, high bigint, split string")
    ranked = random_rank(profile.select("bundle", "g"), ["bundle"], ["g"], seed, largest=max((b.groups for b in bundles), default=1))
    placed = ranked.join(plan, "bundle").where("rank BETWEEN low AND high").select("g", "split")
    return rows.select("id", "g").join(placed, "g").select(F.col("id").alias(id_col), F.col("g").alias(group), "split")
