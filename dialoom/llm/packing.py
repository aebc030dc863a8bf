"""Problem 6: filling containers of fixed capacity (grouping genetic algorithm).

Texts are measured in tokens of a public tokenizer inside Arrow batches. A text above the
capacity is cut: full pieces take a container each, the rest is an item like any other.

Documents are dealt into blocks of about ``block_rows`` by a hash, so that a block is bounded
whatever the table. Each block is packed by several islands, each in a row (and so a task) of its
own. An island evolves a small population of packings, which it keeps from epoch to epoch:
crossover injects whole well-filled containers of one packing into another, drops the containers
they collide with and puts the displaced items back by best fit; mutation empties badly filled
containers and some others and fills them anew as full as one, two or three items make them. After
each epoch the best packing of an island migrates to the next one of the block, in a ring, and
takes the place of its worst; at the end the best of all islands is kept. An island rests when no
packing can have fewer containers, or when nothing has improved for ``PATIENCE`` generations. Every number is drawn from a generator seeded by block and island, so a
lost task is repeated with the same result.

A population costs as much as its block, and blocks are independent, so the work grows in
proportion to the documents. What cutting into blocks can cost is less than one container per
block.

Defined cases: null and empty texts have 0 tokens and take a place in some container; repeated
ids count once (the longest text); null ids are left out; an empty table gives an empty result;
capacities below 1 raise ValueError; further columns are ignored.
"""

from __future__ import annotations

import base64
import os
import random
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.session import Scratch, ship_package, spread

#: Generations without a better packing after which an island waits for the next migration.
PATIENCE = 8

#: Fixed value: the public pre-tokenization pattern that belongs to the vocabulary file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def ship_tokenizer(spark: SparkSession, tokenizer: str) -> str:
    """Sends the vocabulary file to the executors; its name there."""
    where = tokenizer if "://" in tokenizer else f"file://{os.path.abspath(tokenizer)}"
    spark.sparkContext.addFile(where)
    return os.path.basename(tokenizer)


def token_counts(docs: DataFrame, id_col: str, text: str, tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``(id, n)``: tokens of each row's text."""
    ship_package(docs.sparkSession)
    name = ship_tokenizer(docs.sparkSession, tokenizer)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import SparkFiles

        from dialoom.llm import packing

        where = SparkFiles.get(name)
        encode = packing._encoding(where, pattern).encode_ordinary_batch
        for b in batches:
            n = [len(x) for x in encode([t or "" for t in b.column(1).to_pylist()], num_threads=1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], names=["id", "n"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    return spread(rows).mapInArrow(run, schema)


# --- one island ----------------------------------------------------------------------------


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: list[list[int]], room: list[int]) -> None:
    """Puts items, in this order, into the fullest container that takes them; opens new ones."""
    free = sorted((r, i) for i, r in enumerate(room))
    for x in order:
        s = sizes[x]
        at = bisect_left(free, (s, -1))
        if at < len(free):
            r, i = free.pop(at)
        else:
            r, i = capacity, len(bins)
            bins.append([])
            room.append(capacity)
        bins[i].append(x)
        room[i] = r - s
        insort(free, (r - s, i))


def fitness(room: list[int], capacity: int) -> float:
    """Mean squared filling: few containers, and full ones rather than even ones."""
    return sum(((capacity - r) / capacity) ** 2 for r in room) / len(room) if room else 1.0


Packing = tuple[list[list[int]], list[int]]


def crossover(a: Packing, b: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """Well-filled containers of ``b`` go whole into ``a``; what they displace is put back by best fit."""
    (bins_a, room_a), (bins_b, room_b) = a, b
    ranked = sorted(range(len(bins_b)), key=lambda i: room_b[i])
    share = max(1, len(ranked) // 4)
    start = rng.randrange(max(1, len(ranked) // 2))
    inject = ranked[start : start + rng.randint(1, share)]
    inside = {x for i in inject for x in bins_b[i]}
    bins, room = [list(bins_b[i]) for i in inject], [room_b[i] for i in inject]
    displaced: list[int] = []
    for items, r in zip(bins_a, room_a):
        if inside.isdisjoint(items):
            bins.append(list(items))
            room.append(r)
        else:
            displaced += [x for x in items if x not in inside]
    displaced.sort(key=lambda x: -sizes[x])
    best_fit(displaced, sizes, capacity, bins, room)
    return bins, room


def tight_fit(items: list[int], sizes: list[int], capacity: int, bins: list[list[int]], room: list[int]) -> None:
    """Opens containers, each with the largest item left and the one, two or three that fill it best."""
    count, by_size = np.zeros(capacity + 1, np.int64), {}
    for x in items:
        count[sizes[x]] += 1
        by_size.setdefault(sizes[x], []).append(x)
    nothing = by_size.pop(0, [])
    count[0] = 0
    left = len(items) - len(nothing)
    at = np.arange(capacity + 1)
    while left:
        s = int(np.flatnonzero(count)[-1])
        inside, r, take = [], capacity, [s]
        while take:
            for s in take:
                inside.append(by_size[s].pop())
                count[s] -= 1
                r -= s
            left -= len(take)
            take = _best_three(count, at, r) if r and left else []
        bins.append(inside)
        room.append(r)
    if nothing:
        if not bins:
            bins.append([])
            room.append(capacity)
        bins[-1].extend(nothing)


def _best_three(count: np.ndarray, at: np.ndarray, r: int) -> list[int]:
    """At most three sizes at hand with the greatest sum up to r, few and large ones first."""
    s = np.flatnonzero(count[: r + 1])
    if not len(s):
        return []

    def two(q: int) -> list[int]:
        fit = s[: np.searchsorted(s, q, "right")]
        fit = fit[count[fit] > 0]
        if not len(fit):
            return []
        below = np.maximum.accumulate(np.where(count[: q + 1] > 0, at[: q + 1], 0))
        other = below[q - fit]
        other = np.where((other == fit) & (count[fit] < 2), 0, other)
        k = int((fit + other).argmax())
        return [int(x) for x in (fit[k], other[k]) if x]

    best = two(r)
    if sum(best) < r and len(s) > 2:
        for p in s[: -TRIED - 1 : -1].tolist():
            count[p] -= 1
            found = [p, *two(r - p)] if p < r else [p]
            count[p] += 1
            if sum(found) > sum(best):
                best = found
                if sum(best) == r:
                    break
    return best


#: Sizes tried as the largest of three.
TRIED = 12


def mutate(p: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """Empties badly filled containers and some others and fills them anew as full as can be."""
    bins, room = p
    if not bins:
        return p
    ranked = sorted(range(len(bins)), key=lambda i: -room[i])
    out = set(ranked[: rng.randint(1, 1 + len(ranked) // 12)]) | {rng.randrange(len(bins)) for _ in range(1 + len(bins) // 12)}
    loose = [x for i in sorted(out) for x in bins[i]]
    kept = [i for i in range(len(bins)) if i not in out]
    bins, room = [bins[i] for i in kept], [room[i] for i in kept]
    tight_fit(loose, sizes, capacity, bins, room)
    return bins, room


def _packed(assignment: list[int], sizes: list[int], capacity: int) -> Packing:
    n = max(assignment, default=-1) + 1
    bins: list[list[int]] = [[] for _ in range(n)]
    for x, i in enumerate(assignment):
        bins[i].append(x)
    return bins, [capacity - sum(sizes[x] for x in b) for b in bins]


def _assignment(p: Packing, n: int) -> list[int]:
    out = [0] * n
    for i, b in enumerate(p[0]):
        for x in b:
            out[x] = i
    return out


def evolve(sizes: list[int], capacity: int, seed: str, guests: list[list[int]], population: int, generations: int) -> tuple[list[list[int]], float]:
    """One epoch of an island: its packings (container of each item), the best first, and the fitness of that."""
    rng = random.Random(seed)
    n = len(sizes)
    if not n:
        return [[]], 1.0
    pool: list[tuple[float, Packing]] = []
    for g in guests:
        p = _packed(g, sizes, capacity)
        pool.append((fitness(p[1], capacity), p))
    bound = max(1, -(-sum(sizes) // capacity))
    falling = sorted(range(n), key=lambda x: -sizes[x])
    for k in range(len(pool), population):
        p: Packing = ([], [])
        if k == 1:
            tight_fit(falling, sizes, capacity, *p)
        else:
            # the first by decreasing size, the others nearly so
            best_fit(falling if k == 0 else sorted(range(n), key=lambda x: -sizes[x] * rng.uniform(0.9, 1.0)), sizes, capacity, *p)
        pool.append((fitness(p[1], capacity), p))
        if len(p[1]) <= bound:
            break
    # fewer containers first, then the fuller ones
    rank = lambda f: (len(f[1][1]), -f[0])
    idle = 0
    for _ in range(generations):
        pool.sort(key=rank)
        if len(pool[0][1][1]) <= bound or idle >= PATIENCE:
            break
        a, b = pool[rng.randrange(max(1, len(pool) // 2))][1], pool[rng.randrange(len(pool))][1]
        child = mutate(crossover(a, b, sizes, capacity, rng), sizes, capacity, rng)
        new = (fitness(child[1], capacity), child)
        idle = 0 if rank(new) < rank(pool[0]) else idle + 1
        if rank(new) < rank(pool[-1]):
            pool[-1] = new
    pool.sort(key=rank)
    return [_assignment(p, n) for _, p in pool[:population]], pool[0][0]


# --- the operator --------------------------------------------------------------------------


def pack(
    docs: DataFrame,
    packs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    pack_id: str = "pack_id",
    capacity: str = "capacity_tokens",
    tokenizer: str = TOKENIZER,
    pattern: str = PATTERN,
    block_rows: int = 2000,
    islands: int = 3,
    epochs: int = 3,
    population: int = 4,
    generations: int = 16,
) -> DataFrame:
    """``(pack_id, <id>, piece, first_token, n_tokens, container, place)``, one row per piece.

    ``container`` is unique within a pack; ``place`` counts from 1 inside a container.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    idt, pt = docs.schema[id_col].dataType, packs.schema[pack_id].dataType
    if packs.where((F.col(capacity) < 1) | F.col(capacity).isNull()).count():
        raise ValueError("a capacity below 1")
    counted = scratch.table(token_counts(docs, id_col, text, tokenizer, pattern).groupBy("id").agg(F.max("n").alias("n")))
    blocks = max(1, -(-counted.count() // block_rows))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    rows = counted.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("docs"))
    caps = packs.select(F.col(pack_id).alias("pack"), F.col(capacity).cast("bigint").alias("cap")).where("pack IS NOT NULL").distinct()
    rows = rows.select("block", F.col("docs.id").alias("ids"), F.col("docs.n").alias("ns"))
    pieces = _each_capacity(rows, caps)
    state = pieces.withColumn("guests", F.lit(None).cast("array<array<int>>")).withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    evolved = T.StructType(
        [T.StructField("pack", pt), T.StructField("cap", T.LongType()), T.StructField("block", T.LongType()), T.StructField("island", T.IntegerType()),
         T.StructField("pool", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("containers", T.IntegerType()), T.StructField("fitness", T.DoubleType())]
    )

    def one_epoch(epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(whole.num_rows):
                    b = whole.slice(lo, 1)
                    r = b.to_pylist()[0]
                    rest = [n % r["cap"] if n > r["cap"] else n for n in r["ns"]]
                    pool, fit = evolve(rest, r["cap"], f"{r['block']}/{r['pack']}/{r['island']}/{epoch}", r["guests"] or [], population, generations)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0), b.column(1), b.column(2), b.column(3), pa.array([pool], pa.list_(pa.list_(pa.int32()))), pa.array([max(pool[0], default=-1) + 1], pa.int32()), pa.array([fit], pa.float64())],
                        names=evolved.names,
                    )

        return run

    key = ["pack", "cap", "block"]
    wide = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for epoch in range(epochs):
        # islands are spread by block and island; a row is one island, so skew has no way in
        spread = state.select(*key, "island", "ns", "guests").repartition(wide, "block", "pack", "island")
        result = scratch.table(spread.mapInArrow(one_epoch(epoch), evolved))
        if epoch + 1 < epochs:
            own = result.select(*key, "island", F.col("pool").alias("own"))
            from_left = result.select(*key, F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("pool")[0].alias("elite"))
            kept = F.slice("own", 1, F.greatest(F.lit(1), F.least(F.size("own"), F.lit(population - 1))))
            met = own.join(from_left, [*key, "island"]).select(*key, "island", F.concat(kept, F.array("elite")).alias("guests"))
            state = pieces.join(met, key)
    winner = result.groupBy(*key).agg(F.max_by(F.col("pool")[0], F.struct(-F.col("containers"), F.col("fitness"), -F.col("island"))).alias("best"))
    final = pieces.join(winner, key)
    out = T.StructType(
        [T.StructField(pack_id, pt), T.StructField(id_col, idt), T.StructField("piece", T.IntegerType()), T.StructField("first_token", T.LongType()),
         T.StructField("n_tokens", T.LongType()), T.StructField("container", T.LongType()), T.StructField("place", T.IntegerType())]
    )

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(whole.num_rows):
                b = whole.slice(lo, 1)
                r = b.to_pylist()[0]
                cap, base = r["cap"], r["block"] << 24
                used = max(r["best"], default=-1) + 1
                filled = [0] * used
                rows = []  # document, piece, first token, tokens, container, place
                for x, (size, best) in enumerate(zip(r["ns"], r["best"])):
                    full = size // cap if size > cap else 0
                    rows += [(x, k, k * cap, cap, base + used + k, 1) for k in range(full)]
                    used += full
                    if size <= cap or size % cap:
                        filled[best] += 1
                        rows.append((x, full, full * cap, size - full * cap, base + best, filled[best]))
                at, *columns = zip(*rows)
                ids = pa.array(r["ids"], b.column(3).type.value_type).take(pa.array(at, pa.int64()))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                packs_ = pa.array([r["pack"]] * len(rows), b.column(0).type)
                yield pa.RecordBatch.from_arrays([packs_, ids, *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=out.names)

    return final.select("pack", "cap", "block", "ids", "ns", "best").mapInArrow(lay_out, out)


def _each_capacity(rows: DataFrame, caps: DataFrame) -> DataFrame:
    """Every block with every container size; the sizes are a parameter list, checked to be one."""
    sizes = caps.orderBy("pack").take(1001)
    if len(sizes) > 1000:
        raise ValueError("more than 1000 container sizes")
    if not sizes:
        return rows.withColumn("pack", F.lit(None).cast(caps.schema["pack"].dataType)).withColumn("cap", F.lit(None).cast("bigint")).where("false")
    each = F.array(*[F.struct(F.lit(r.pack).cast(caps.schema["pack"].dataType).alias("pack"), F.lit(r.cap).cast("bigint").alias("cap")) for r in sizes])
    return rows.withColumn("one", F.explode(each)).select("block", "ids", "ns", F.col("one.pack").alias("pack"), F.col("one.cap").alias("cap"))
