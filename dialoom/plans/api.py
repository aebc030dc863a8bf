"""The commands as functions: validate, plan, generate, export, render, evaluate."""

from __future__ import annotations

import json
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import backend, checks, quota, runner, scoring, transcript
from dialoom.session import Scratch, exclusive, exists, read_text, rename
from dialoom.sources import files

MODES = ("task", "topic_chat", "open_chat")
TONES = ("neutral", "gentle", "sharp")


def validate(users: DataFrame, topics: DataFrame, characters: DataFrame) -> dict[str, int]:
    """Checks the catalogue, writes nothing, and gives its counts."""
    checks.require(users, "id", checks.user_rules())
    checks.require(topics, "id", {"id": checks.nonblank(F.col("id")), "name": checks.nonblank(F.col("name")), "seeds": checks.text_list(F.col("seeds"))})
    for df in (users, topics, characters):
        first = checks.repeated_keys(df, "id").first()
        if first:
            raise ValueError(f"{first.id} occurs {first.n} times")
    return {"users": users.count(), "topics": topics.count(), "characters": characters.count()}


def plan(users: DataFrame, topics: DataFrame, characters: DataFrame, count: int, seed: int, weights: dict[str, dict[str, Decimal]], mode: str | None = None, tone: str | None = None, folder: str | None = None) -> DataFrame:
    """A plan of ``count`` jobs; with a folder it is appended there under the next ids."""
    if count <= 0:
        raise ValueError("count must be positive")
    spark = users.sparkSession
    modes, tones = quota.override(weights["mode"], mode), quota.override(weights["tone"], None if tone == "random" else tone)
    make = lambda first: quota.plan_jobs(users, topics, characters, count, seed, modes, tones, first, random_tones=tone == "random")
    if not folder:
        return make(1)
    # the next number is read and used under one lock
    with exclusive(spark, folder):
        first = 1
        if exists(spark, f"{folder}/jobs"):
            first = quota.next_number(spark.read.parquet(f"{folder}/jobs").withColumnRenamed("id", "dialogue_id")).first().next_number
        runner.append_rows(with_snapshots(make(first), users, topics, characters), f"{folder}/jobs")
    return spark.read.parquet(f"{folder}/jobs")


def with_snapshots(jobs: DataFrame, users: DataFrame, topics: DataFrame, characters: DataFrame) -> DataFrame:
    """The plan with what a run needs of its rows, so that a later catalogue does not change it (T5)."""
    whole = lambda df, drop: F.to_json(F.struct(*[c for c in df.columns if c not in drop]))
    text = lambda df, c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    one = lambda df, key, **cols: df.select(F.col("id").alias(key), *[c.alias(k) for k, c in cols.items()]).dropDuplicates([key])
    u = one(users, "user_id", user_profile=whole(users, ("communication_style",)))
    t = one(topics, "topic_id", topic_name=text(topics, "name"), boundary=text(topics, "boundary"))
    c = one(characters, "character_id", character_name=F.coalesce(text(characters, "name"), F.col("id").cast("string")), character_profile=whole(characters, ()))
    return jobs.join(u, "user_id", "left").join(t, "topic_id", "left").join(c, "character_id", "left")


def check_options(command: str, **given) -> None:
    """Which options go together."""
    if command not in ("validate", "plan", "generate", "export", "render", "evaluate"):
        raise ValueError(f"unknown command {command}")
    have = {k for k, v in given.items() if v not in (None, False)}
    if {"append", "resume"} <= have:
        raise ValueError("append and resume exclude each other")
    if "append" in have and command not in ("plan", "generate"):
        raise ValueError("append goes with plan and generate only")
    fixed = have & {"character", "user", "mode", "tone", "behaviours"}
    if fixed and command in ("export", "render"):
        raise ValueError(f"{', '.join(sorted(fixed))} go with validate, plan and generate only")
    if "resume" in have and fixed & {"mode", "tone", "behaviours"}:
        raise ValueError("resume uses the saved choices")


def generate(spark: SparkSession, folder: str, make: Callable[[], object] = backend.Stub, max_rounds: int = 20, settings: dict | None = None) -> DataFrame:
    """Runs the planned jobs of a folder to their end, or on from where a run was broken off."""
    with exclusive(spark, folder):
        where = f"{folder}/settings.json"
        stored = json.loads(read_text(spark, where)) if exists(spark, where) else None
        runner.check_settings(stored, settings or {}, exists(spark, f"{folder}/turns"))
        runner.write_json(spark, where, settings or {})
        jobs = spark.read.parquet(f"{folder}/jobs").withColumnRenamed("id", "dialogue_id")
        return runner.run_batch(jobs, folder, make, max_rounds)


def as_messages(turns: DataFrame) -> DataFrame:
    """Stored turns as messages with a header at position 0."""
    role = F.when(F.col("speaker") == "user", "user").otherwise("assistant")
    body = turns.select("dialogue_id", (F.col("pos") + 1).cast("int").alias("pos"), role.alias("role"), "content")
    head = turns.select("dialogue_id").distinct().select("dialogue_id", F.lit(0).alias("pos"), F.lit("system").alias("role"), F.lit("{}").alias("content"))
    return head.unionByName(body)


def export(messages: DataFrame, path: str, one_file: bool = False) -> int:
    """Distinct training records as JSON lines; how many."""
    records = transcript.training_export(transcript.training_rows(transcript.turns(messages)))
    runner.export_jsonl(records, path, one_file)
    return records.count()


def score_tasks(messages: DataFrame, limit: int | None = None, meta: DataFrame | None = None, modes: list[str] | None = None) -> DataFrame:
    """The grid of tasks with ``context``, the digest of all a judge sees.

    ``meta`` (dialogue_id, mode, ...) adds the scene to the context; ``modes`` keeps some modes
    only; ``limit`` keeps the first replies in the order of ids and rounds.
    """
    samples = transcript.reply_samples(transcript.turns(messages))
    if meta is not None:
        samples = samples.join(checks.in_modes(meta, modes), "dialogue_id")
    elif modes:
        raise ValueError("modes need the table of dialogues")
    if limit is not None:
        samples = samples.orderBy("dialogue_id", "round").limit(limit)
    shown = [c for c in samples.columns if c not in ("dialogue_id", "round")]
    samples = samples.withColumn("context", scoring.context_digest(*[F.col(c) for c in shown]))
    return scoring.task_grid(samples, files.rubric(messages.sparkSession))


def evaluate(
    messages: DataFrame, store: str, make: Callable[[], object] = backend.Stub, limit: int | None = None, meta: DataFrame | None = None, modes: list[str] | None = None,
    settings: dict | None = None, reload: Callable[[], DataFrame] | None = None, check_only: bool = False,
) -> DataFrame:
    """Scores what has no valid score yet, appends to the folder ``store``, and gives the rollup per principle.

    A stored score counts while its task's context is unchanged (T11); two that contradict each
    other are an error before anything is asked (T10). Failed and malformed replies go to
    ``failures`` and do not stop the others (T8, K5). If ``reload`` is given, the messages are read
    again before the write, and tasks whose context has changed meanwhile are not stored (T9).
    With ``check_only`` nothing is asked or written, and the tasks themselves are returned (X8).
    """
    spark = messages.sparkSession
    tasks = score_tasks(messages, limit, meta, modes)
    if check_only:
        return tasks
    with exclusive(spark, store):
        where = f"{store}/manifest.json"
        manifest = {"settings": settings or {}, "rubric": [d for d, _, _ in files.RUBRIC]}
        if exists(spark, where) and json.loads(read_text(spark, where)) != manifest:
            raise ValueError("the judge's settings have changed; use another folder")
        runner.write_json(spark, where, manifest)
        scratch = Scratch(spark, "evaluate")
        tasks = scratch.table(tasks)
        fields = "task_id string, dialogue_id string, round int, principle string, ord int, context string, score int, reason string"
        read = lambda: spark.read.schema(fields).parquet(f"{store}/scores") if exists(spark, f"{store}/scores") else spark.createDataFrame([], fields)
        one = read().groupBy("task_id", "context").agg(F.count_distinct("score", "reason").alias("n")).where("n > 1").first()
        if one:
            raise ValueError(f"stored scores of {one.task_id} contradict each other")
        done = read().join(tasks.select("task_id", "context"), ["task_id", "context"], "left_semi")
        prompt = F.concat_ws("\n", "principle", transcript.history_text(F.col("history")), "model_response", F.format_string('{"%s": {"score": 1, 3 or 5, "reason": "..."}}', "principle"))
        asked = scoring.pending_tasks(tasks, done).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))))
        keep = ("task_id", "dialogue_id", "round", "principle", "ord", "context")
        replies = scratch.table(backend.complete_rows(asked, "judge", make, keep=keep, check=backend.judge_reply, expect="principle"))
        item = F.try_element_at(F.from_json(F.regexp_extract("reply", r"(?s)\{.*\}", 0), "map<string,struct<score:int,reason:string>>"), F.col("principle"))
        good = replies.where("reply IS NOT NULL").select(*keep, item["score"].alias("score"), item["reason"].alias("reason"))
        failed = replies.where("reply IS NULL").select("task_id", "dialogue_id", "error", "attempts")
        if reload:
            now = score_tasks(reload(), limit, meta, modes).select("task_id", "context")
            changed = good.join(now, ["task_id", "context"], "left_anti").select("task_id", "dialogue_id", F.lit("changed").alias("error"), F.lit(None).cast(backend.ATTEMPTS).alias("attempts"))
            good = good.join(now, ["task_id", "context"], "left_semi")
            failed = failed.unionByName(changed)
        runner.append_rows(failed.withColumn("at", F.current_timestamp()), f"{store}/failures")
        runner.append_rows(good, f"{store}/scores")
        valid = read().join(tasks.select("task_id", "context"), ["task_id", "context"], "left_semi").dropDuplicates(["task_id"])
        if limit is not None:
            # the rollup covers all replies, those beyond the limit included
            every = score_tasks(messages, None, meta, modes).select("task_id", "context")
            valid = read().join(every, ["task_id", "context"], "left_semi").dropDuplicates(["task_id"])
        runner.write_json(spark, f"{store}/summary.json", {"expected": tasks.count(), "completed": valid.join(tasks.select("task_id"), "task_id", "left_semi").count(), "failed": failed.count()})
        return scoring.ordered(scoring.aggregate(valid))


def migrate_scores(spark: SparkSession, legacy: str, tasks: DataFrame, context: list[str], store: str) -> int:
    """Old scores into the store, all or none; the old table stays as a backup under a new name."""
    if not exists(spark, legacy):
        return 0
    good, problems = scoring.migrate(spark.read.parquet(legacy), tasks, context)
    first = problems.first()
    if first:
        raise ValueError(f"{first.task_id}: {first.problem}")
    staged = Scratch(spark, "migrate").table(good)
    runner.append_rows(staged, store)
    backup, k = f"{legacy}.legacy", 0
    while exists(spark, backup):
        k += 1
        backup = f"{legacy}.legacy.{k}"
    rename(spark, legacy, backup)
    return staged.count()
