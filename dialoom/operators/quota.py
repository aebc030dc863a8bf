"""Apportionment and sampling of plans.

Weights are exact: decimals are scaled to integers, and quotas come from integer division and
remainder, so 0.29 of 100 is 29.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.operators.ranks import random_rank
from dialoom.session import Scratch


def checked_weights(weights: dict, keys: tuple[str, ...]) -> dict[str, Decimal]:
    """Finite numbers within 0 and 1, exactly these keys, a sum of 1 within 1e-9; canonical order."""
    if not isinstance(weights, dict) or set(weights) != set(keys):
        raise ValueError(f"weights must have exactly the keys {', '.join(keys)}")
    for v in weights.values():
        if isinstance(v, bool) or not isinstance(v, (int, float, Decimal)) or not math.isfinite(v) or not 0 <= v <= 1:
            raise ValueError("weights must be finite numbers between 0 and 1")
    if abs(sum(Fraction(str(v)) for v in weights.values()) - 1) > Fraction(1, 10**9):
        raise ValueError("weights must sum to 1")
    return {k: Decimal(str(weights[k])) for k in keys}


def override(weights: dict[str, Decimal], fixed: str | None) -> dict[str, Decimal]:
    """A fixed choice becomes weights of one and zeros."""
    if fixed is None:
        return weights
    if fixed not in weights:
        raise ValueError(f"{fixed} is none of {', '.join(weights)}")
    return {k: Decimal(int(k == fixed)) for k in weights}


def weights_table(spark: SparkSession, axes: dict[str, dict[str, Decimal]]) -> DataFrame:
    """(axis, key, ord, w): weights scaled to integers by one power of ten per axis."""
    rows = []
    for axis, weights in axes.items():
        places = max([0, *(-Decimal(v).as_tuple().exponent for v in weights.values())])
        rows += [(axis, k, i, int(Decimal(v) * 10**places)) for i, (k, v) in enumerate(weights.items())]
    return spark.createDataFrame(rows, "axis string, key string, ord int, w bigint")


def largest_remainder(rows: DataFrame, by: list[str], n: str = "n", w: str = "w", order: str = "ord", out: str = "seats") -> DataFrame:
    """A1, A2: seats per row within each group of ``by``; ties go by ``order``.

    ``n`` is the number to hand out, equal within a group; the total weight is normalised, and a
    group with weights of zero gets none.
    """
    group = Window.partitionBy(*by)
    total = F.sum(w).over(group)
    num = F.col(n).cast("decimal(38,0)") * F.col(w)
    with_floor = rows.withColumns({"__t": total}).withColumns(
        {"__f": F.when(F.col("__t") > 0, F.floor(num / F.col("__t"))).otherwise(F.lit(0)).cast("bigint")}
    )
    # the exact remainder, by integers
    with_rest = with_floor.withColumn("__r", F.when(F.col("__t") > 0, (num - F.col("__f") * F.col("__t")).cast("bigint")).otherwise(F.lit(0)))
    left = F.when(F.col("__t") > 0, F.col(n)).otherwise(F.lit(0)) - F.sum("__f").over(group)
    place = F.row_number().over(group.orderBy(F.desc("__r"), order))
    return with_rest.withColumns({"__left": left, "__p": place}).withColumn(out, (F.col("__f") + (F.col("__p") <= F.col("__left")).cast("int")).cast("bigint")).drop("__t", "__f", "__r", "__left", "__p")


def quota(n: int, weights: dict[str, int | Decimal | Fraction]) -> dict[str, int]:
    """A1 on the driver, for a handful of keys."""
    exact = {k: Fraction(str(v)) if not isinstance(v, Fraction) else v for k, v in weights.items()}
    total = sum(exact.values())
    if n < 0 or (n and total <= 0):
        raise ValueError("a number from 0 and a positive total are needed")
    if not n:
        return dict.fromkeys(weights, 0)
    out = {k: int(n * v / total) for k, v in exact.items()}
    for k in sorted(weights, key=lambda k: n * exact[k] / total - out[k], reverse=True)[: n - sum(out.values())]:
        out[k] += 1
    return out


def two_way(rows: dict[str, int], columns: dict[str, int], salt: str = "") -> dict[str, dict[str, int]]:
    """A3: a table with both margins exact; rows in a salted order share what the columns have left."""
    import hashlib

    if sum(rows.values()) != sum(columns.values()):
        raise ValueError("margins must have equal totals")
    key = lambda k: hashlib.md5(f"{salt}|{k}".encode()).hexdigest()
    left = {c: columns[c] for c in sorted(columns, key=key)}
    out = {}
    for r in sorted(rows, key=key):
        out[r] = quota(rows[r], left) if rows[r] else dict.fromkeys(left, 0)
        left = {c: left[c] - out[r][c] for c in left}
    return {r: {c: out[r][c] for c in columns} for r in rows}


def number_of(text: Column, digits: int = 13) -> Column:
    """A number of 52 bits from the MD5 of a text (the same in any SQL engine)."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def numbered(df: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct keys with consecutive numbers from 0, in the order of their MD5; any size of table."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return random_rank(keys, [], [key], "", out, hex_order=F.md5(F.col(key).cast("string"))).select(key, (F.col(out) - 1).cast("bigint").alias(out))


def sample_product(spark: SparkSession, n: int, sizes: list[int], salt: str) -> DataFrame:
    """N distinct cells of a product, without making the product: (draw, i0, i1, ...).

    Numbers of cells are drawn by hash and repeated ones skipped, which is uniform without
    replacement; only if n is above a quarter of the cells are all of them put in hash order.
    Raises ValueError if there are fewer cells than asked for (A4).
    """
    cells = math.prod(sizes)
    if n > cells:
        raise ValueError(f"{n} distinct combinations are asked for, {cells} are there")
    if 4 * n >= cells:
        drawn = spark.range(cells).select(F.col("id").alias("cell"), F.col("id").alias("try"))
    else:
        # with at most a quarter taken, twice n draws hold more than n distinct cells
        draws = spark.range(1, 2 * n + 65).select(F.col("id").alias("try"), F.pmod(number_of(F.concat(F.lit(f"{salt}|"), F.col("id").cast("string"))), F.lit(cells)).alias("cell"))
        drawn = draws.groupBy("cell").agg(F.min("try").alias("try"))
    order = F.md5(F.concat(F.lit(f"{salt}|order|"), F.col("try").cast("string")))
    chosen = random_rank(drawn, [], ["cell"], salt, "draw", hex_order=order).where(F.col("draw") <= n)
    place = [F.expr(f"(cell div {math.prod(sizes[:i])}) % {size}").alias(f"i{i}") for i, size in enumerate(sizes)]
    return chosen.select(F.col("draw").cast("bigint").alias("draw"), *place)


def choose_from(array: Column, salt: str, key: Column) -> Column:
    """One element by hash; null for an empty array. A salt is a stream of its own."""
    n = F.size(array)
    at = F.pmod(number_of(F.concat(F.lit(f"{salt}|"), key)), F.when(n > 0, n).cast("bigint"))
    return F.try_element_at(array, (at + 1).cast("int"))


def salted_order(salt: str, key: Column) -> Column:
    """Sorting by this is a seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{salt}|"), key))


def plan_jobs(
    users: DataFrame, topics: DataFrame, characters: DataFrame, count: int, seed: int,
    modes: dict[str, Decimal], tones: dict[str, Decimal], first_number: int = 1, random_tones: bool = False,
) -> DataFrame:
    """A stratified plan (id, mode, tone, user, topic, character, seed_situation).

    Per mode distinct triples are drawn from the product (pairs, for modes without a topic);
    the plan is shuffled; tones are dealt within modes by a two-way table with exact margins. The
    material depends on seed and mode only, so other tone weights leave it unchanged. With
    ``random_tones`` (A14) each job draws its tone by itself, past the quotas.
    """
    spark = users.sparkSession
    by_mode, by_tone = quota(count, modes), quota(count, tones)
    table = two_way(by_mode, by_tone, f"quota_behavior:{seed}")
    # each step below reads its input more than once, so it is written once
    scratch = Scratch(spark, "plan")
    u, c, t = (scratch.table(numbered(x, "id", i)) for x, i in ((users, "iu"), (characters, "ic"), (topics, "it")))
    nu, nc, nt = u.count(), c.count(), t.count()
    seeds = topics.groupBy("id").agg(F.max("seeds").alias("seeds"))
    parts = []
    for mode, n in by_mode.items():
        if not n:
            continue
        open_chat = mode == "open_chat"
        cells = sample_product(spark, n, [nu, nc] if open_chat else [nu, nc, nt], f"quota_material:{seed}:{'open' if open_chat else 'topic'}")
        parts.append(cells.select(F.lit(mode).alias("mode"), F.col("draw"), F.col("i0").alias("iu"), F.col("i1").alias("ic"), (F.lit(None).cast("bigint") if open_chat else F.col("i2")).alias("it")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.join(u.withColumnRenamed("id", "user_id"), "iu").join(c.withColumnRenamed("id", "character_id"), "ic")
    rows = rows.join(t.withColumnRenamed("id", "topic_id"), "it", "left")
    rows = rows.join(seeds.withColumnRenamed("id", "topic_id"), "topic_id", "left")
    rows = scratch.table(rows)
    slot = F.concat_ws("|", "mode", F.col("draw").cast("string"))
    bounds = []
    for mode, row in table.items():
        low = 0
        for tone, n in row.items():
            if n:
                bounds.append((mode, low + 1, low + n, tone))
            low += n
    tone_rows = spark.createDataFrame(bounds, "mode string, low bigint, high bigint, tone string")
    rows = random_rank(rows, ["mode"], ["draw"], "", "place", hex_order=salted_order(f"quota_behavior:{seed}", slot))
    # as many rows as there are cells in the table of modes and tones
    rows = scratch.table(rows.join(tone_rows, "mode").where("place BETWEEN low AND high"))
    rows = random_rank(rows, [], ["mode", "draw"], "", "number", hex_order=salted_order(f"quota_order:{seed}", slot))
    if random_tones:
        rows = rows.withColumn("tone", choose_from(F.array(*[F.lit(t) for t in tones]), f"user_behaviors:{seed}", slot))
    number = F.col("number") + (first_number - 1)
    situation = F.when(F.col("mode") == "task", choose_from(F.col("seeds"), f"seed_situation:{seed}", slot))
    return rows.select(F.format_string("dialogue_%05d", number).alias("id"), "mode", "tone", "user_id", "topic_id", "character_id", situation.alias("seed_situation"))


def next_number(ids: DataFrame, col: str = "dialogue_id") -> DataFrame:
    """(next_number, next_id) after the largest whole id."""
    from dialoom.functions.text import id_number

    n = F.coalesce(F.max(id_number(F.col(col))), F.lit(0)) + 1
    return ids.agg(n.alias("next_number")).withColumn("next_id", F.format_string("dialogue_%05d", "next_number"))


def plan_summary(plan: DataFrame, targets: dict[str, dict[str, int]]) -> DataFrame:
    """(axis, key, target, actual), zero-filled over the domains."""
    spark = plan.sparkSession
    want = spark.createDataFrame([(a, k, n) for a, t in targets.items() for k, n in t.items()], "axis string, key string, target bigint")
    got = None
    for axis in targets:
        one = plan.groupBy(F.lit(axis).alias("axis"), F.col(axis).alias("key")).agg(F.count("*").alias("actual"))
        got = one if got is None else got.unionByName(one)
    return want.join(got, ["axis", "key"], "full").select("axis", "key", F.coalesce("target", F.lit(0)).alias("target"), F.coalesce("actual", F.lit(0)).alias("actual"))


def preset_problems(presets: DataFrame, tone_quota: dict[str, int]) -> DataFrame:
    """Tones that need exactly one preset and have none, or several."""
    need = presets.sparkSession.createDataFrame([(t,) for t, n in tone_quota.items() if n], "tone string")
    counts = presets.groupBy("tone").agg(F.count("*").alias("presets"))
    return need.join(counts, "tone", "left").select("tone", F.coalesce("presets", F.lit(0)).alias("presets")).where("presets <> 1")


def with_presets(plan: DataFrame, presets: DataFrame) -> DataFrame:
    """The plan with the preset of each tone (``preset_id``); tones are a closed set of a few."""
    return plan.join(presets.select("tone", F.col("id").alias("preset_id")), "tone", "left")
