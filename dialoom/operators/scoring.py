"""Rubric scores: tasks, validation, rollups, incremental storage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import sample_id, task_id


def task_grid(samples: DataFrame, dims: DataFrame) -> DataFrame:
    """Each sample with each dimension of the fixed rubric (seven rows), with ``task_id``.

    The rubric is exploded from a literal array, so there is no join at all.
    """
    rows = dims.orderBy("ord").take(101)
    if len(rows) > 100:
        raise ValueError("a rubric has at most 100 dimensions")
    each = F.array(*[F.struct(F.lit(r.dimension_id).alias("dimension_id"), F.lit(r.principle).alias("principle"), F.lit(r.ord).alias("ord")) for r in rows])
    out = samples.withColumn("sample_id", sample_id(F.col("dialogue_id"), F.col("round"))).withColumn("d", F.explode(each))
    return out.select(*samples.columns, "sample_id", "d.*").withColumn("task_id", task_id(F.col("sample_id"), F.col("dimension_id"), F.col("principle")))


def pending_tasks(tasks: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks without a stored score."""
    return tasks.join(done.select("task_id"), "task_id", "left_anti")


def valid_scores(text: Column, principles: list[str]) -> Column:
    """The parsed scores of a judge's reply, or null.

    Exactly these keys; each score an integer (no text, no boolean, no fraction) of 1, 3 or 5;
    each reason text that is not blank; no further fields.
    """
    inner = "struct<score:int,reason:string>"
    strict = F.from_json(text, f"map<string,{inner}>", {"mode": "PERMISSIVE"})
    names = F.array_sort(F.json_object_keys(text))
    exact = names == F.array(*[F.lit(p) for p in sorted(principles)])
    checks = [exact]
    for p in principles:
        one = F.get_json_object(text, f"$['{p}']")
        item = F.try_element_at(strict, F.lit(p))
        reason_text = F.try_variant_get(F.try_parse_json(text), f"$['{p}'].reason", "string")
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$['{p}'].reason", "variant"))
        checks += [
            F.array_sort(F.json_object_keys(one)) == F.array(F.lit("reason"), F.lit("score")),
            item["score"].isin(1, 3, 5),
            (kind == "STRING") & F.regexp_like(reason_text, F.lit(r"(?U)\S")),
        ]
    return F.when(F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False)), strict)


def aggregate(scores: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Count, mean, counts of 1/3/5 and the macro mean per principle (and ``by``).

    Two levels of aggregation serve both means: sums per dialogue, then over dialogues, so the
    facts are shuffled once.
    """
    keys = [*(by or []), "principle"]
    per = scores.groupBy(*keys, "dialogue_id").agg(
        F.count("*").alias("n"), F.sum("score").alias("s"), *[F.count_if(F.col("score") == k).alias(f"c{k}") for k in (1, 3, 5)]
    )
    return per.groupBy(*keys).agg(
        F.sum("n").alias("n_scores"), (F.sum("s") / F.sum("n")).alias("mean_score"),
        *[F.sum(f"c{k}").alias(f"n_score_{k}") for k in (1, 3, 5)], F.avg(F.col("s") / F.col("n")).alias("macro_mean"),
    )


def aggregate_sets(scores: DataFrame, sets: dict[str, str]) -> DataFrame:
    """G3 over several groupings at once: (grouping, key, principle, ...). One expand, one plan."""
    each = F.array(F.struct(F.lit("all").alias("grouping"), F.lit("").alias("key")), *[F.struct(F.lit(g).alias("grouping"), F.col(c).alias("key")) for g, c in sets.items()])
    rows = scores.select("dialogue_id", "principle", "score", F.explode(each).alias("g")).select("dialogue_id", "principle", "score", "g.*")
    return aggregate(rows, ["grouping", "key"])


def dialogue_average(scores: DataFrame) -> DataFrame:
    """All scores of a dialogue equally, half-even at four places."""
    return scores.groupBy("dialogue_id").agg(F.bround(F.avg("score"), 4).alias("average_score"), F.count("*").alias("n_scores"))


def completion(samples: DataFrame, scores: DataFrame, n_dims: int) -> DataFrame:
    """Expected and completed tasks per dialogue, those without any score included."""
    want = samples.groupBy("dialogue_id").agg((F.count("*") * n_dims).alias("expected"))
    got = scores.groupBy("dialogue_id").agg(F.count("*").alias("completed"))
    rows = want.join(got, "dialogue_id", "left").withColumn("completed", F.coalesce("completed", F.lit(0)))
    return rows.withColumn("complete", F.col("expected") == F.col("completed"))


def fully_scored(scores: DataFrame, n_dims: int) -> DataFrame:
    """Samples with a score for each dimension."""
    return scores.groupBy("sample_id").agg(F.count("*").alias("n")).where(F.col("n") == n_dims).select("sample_id")


def inline_scores(scores: DataFrame) -> DataFrame:
    """O2, O3, K6: per dialogue the map from round to its scores in rubric order."""
    item = F.struct("ord", F.col("principle").alias("dimension"), "score", "reason")
    plain = F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["dimension"].alias("dimension"), x["score"].alias("score"), x["reason"].alias("reason")))
    rounds = scores.groupBy("dialogue_id", F.format_string("round_%02d", "round").alias("k")).agg(plain.alias("v"))
    return rounds.groupBy("dialogue_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("scores"))


def from_inline(rows: DataFrame, dims: DataFrame, strict: bool = True) -> DataFrame:
    """The flat fact table back from the nested one.

    A principle that the rubric does not have, or that comes twice in a round, is an error;
    without ``strict`` such items stay, with a null id if they are unknown.
    """
    flat = rows.select("dialogue_id", F.explode("scores").alias("k", "items")).select("dialogue_id", F.substring("k", 7, 9).cast("int").alias("round"), F.explode("items").alias("i"))
    flat = flat.select("dialogue_id", "round", F.col("i.dimension").alias("principle"), "i.score", "i.reason")
    out = flat.join(dims.select("principle", "dimension_id"), "principle", "left").select("dialogue_id", "round", "principle", "dimension_id", "score", "reason")
    if strict:
        first = out.where("dimension_id IS NULL").first()
        if first:
            raise ValueError(f"{first.dialogue_id}: unknown principle {first.principle}")
        twice = out.groupBy("dialogue_id", "round", "principle").count().where("count > 1").first()
        if twice:
            raise ValueError(f"{twice.dialogue_id}: {twice.principle} comes twice")
    return out


def ordered(df: DataFrame) -> DataFrame:
    """A rollup in the order of its groups and principles."""
    return df.orderBy(*[c for c in ("grouping", "key", "dialogue_id", "round", "principle") if c in df.columns])


def context_digest(*columns: Column) -> Column:
    """What a score was given for; a score stays valid while this is unchanged."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def merge_scores(stored: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts). A key stored already must have the same value."""
    cols = ["task_id", "score", "reason"]
    both = stored.select(*cols).join(new.select("task_id", F.col("score").alias("new_score"), F.col("reason").alias("new_reason")), "task_id", "full")
    clash = F.col("score").isNotNull() & F.col("new_score").isNotNull() & ~(F.col("score").eqNullSafe(F.col("new_score")) & F.col("reason").eqNullSafe(F.col("new_reason")))
    merged = both.where(~clash).select("task_id", F.coalesce("score", "new_score").alias("score"), F.coalesce("reason", "new_reason").alias("reason"))
    return merged, both.where(clash).select("task_id", "score", "new_score")


def retained(old: DataFrame, new: DataFrame, context: list[str], id_col: str = "dialogue_id") -> DataFrame:
    """Ids whose context is unchanged, so that their scores may stay."""
    print_ = lambda df, name: df.select(id_col, F.sha2(F.to_json(F.struct(*context), {"ignoreNullFields": "false"}), 256).alias(name))
    return print_(old, "a").join(print_(new, "b"), id_col).where("a = b").select(id_col)


def batch_fingerprint(samples: DataFrame, extra: dict) -> str:
    """A digest of the batch's contents and settings, independent of order and paths."""
    from dialoom.functions.json_text import digest_of

    row = samples.select(F.xxhash64(F.to_json(F.struct(*sorted(samples.columns)))).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("s")).first()
    return digest_of({"n": row.n, "sum": str(row.s), **extra})


def migrate(legacy: DataFrame, tasks: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
    """(scores to store, problems). Nothing should be stored unless problems is empty.

    A problem is an unknown task, a task that comes twice, or a context that differs.
    """
    counted = legacy.groupBy("task_id").agg(F.count("*").alias("copies"))
    rows = legacy.join(counted, "task_id").alias("l").join(tasks.alias("t"), "task_id", "left")
    changed = reduce(lambda a, b: a | b, [~F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}")) for c in context])
    why = F.when(F.col("t.sample_id").isNull(), "unknown").when(F.col("copies") > 1, "duplicate").when(changed, "changed")
    judged = rows.select("task_id", "l.score", "l.reason", why.alias("problem"))
    return judged.where("problem IS NULL").drop("problem"), judged.where("problem IS NOT NULL").select("task_id", "problem")


def attempt_totals(attempts: DataFrame, by: list[str], usage: str = "usage", ok: str = "ok") -> DataFrame:
    """Attempts, successful ones and summed integer counters of a usage map, per group.

    Counters are summed per key before they are put into a map, so there is no limit on keys.
    """
    base = attempts.groupBy(*by).agg(F.count("*").alias("attempts"), F.count_if(F.col(ok)).alias("succeeded"))
    each = attempts.select(*by, F.explode(usage).alias("k", "v")).where("v IS NOT NULL").groupBy(*by, "k").agg(F.sum("v").alias("v"))
    maps = each.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("totals"))
    return base.join(maps, by, "left")
