"""Dialogues in rounds over all of them at once (T1 to T6): append-only turns, resumable.

A superstep gives every open dialogue its next turn. Turns are keyed by (dialogue_id, pos) and
appended; the state of what is open is carried from step to step in the shared folder and is read
from the stored turns only when a run begins, so a run that was broken off goes on in the middle
of a round without asking again. Beside the turns a run appends its scenes, events, attempts and
failures. ``session.exclusive`` keeps a folder to one run (T15).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators import backend
from dialoom.operators.backend import Stub, complete_rows
from dialoom.operators.transcript import actor_messages, actor_system, scene
from dialoom.session import Scratch, exists, write_text

TURN = "dialogue_id string, pos int, speaker string, content string, goal_completed boolean"
#: What a job may bring along; absent columns are null.
MATERIAL = ("mode", "tone", "topic_name", "boundary", "seed_situation", "goal", "user_profile", "character_name", "character_profile")
#: The wording of this project.
SYSTEM = {"user": "You are the user of this dialogue. Answer with a JSON object of message and goal_completed.", "character": "You are the character of this dialogue. Answer with your turn only."}
OPENING = "Begin the talk as the scene suggests."
GOAL = "Talk about the topic until your question is answered, then go on or say goodbye."


def check_settings(stored: dict | None, settings: dict, started: bool) -> None:
    """Settings of a batch may change only before its first turn."""
    if stored is not None and started and stored != settings:
        raise ValueError("the settings have changed since the batch began")


def state_of(turns: DataFrame, max_rounds: int) -> DataFrame:
    """Per dialogue the number of turns, who is next, what was said, the goal flags, and why it is over (null: it is not)."""
    said = F.array_sort(F.collect_list(F.struct("pos", "speaker", "content", "goal_completed")))
    per = turns.groupBy("dialogue_id").agg(said.alias("all")).select(
        "dialogue_id", F.size("all").alias("n"),
        F.transform("all", lambda x: F.struct(x["speaker"].alias("speaker"), x["content"].alias("content"))).alias("said"),
        F.map_from_entries(F.transform(F.filter("all", lambda x: x["speaker"] == "user"), lambda x: F.struct((F.floor(x["pos"] / 2) + 1).cast("int"), F.coalesce(x["goal_completed"], F.lit(False))))).alias("flags"),
    )
    return _judged(per, max_rounds)


def _judged(per: DataFrame, max_rounds: int) -> DataFrame:
    even, done = F.col("n") % 2 == 0, F.expr("cast(n div 2 as int)")
    goal = F.coalesce(F.try_element_at("flags", done), F.lit(False))
    why = F.when(even & (F.col("n") > 0) & goal, "user_goal_completed").when(even & (done >= max_rounds), "max_turns")
    return per.withColumns({"next": F.when(even, "user").otherwise("character"), "stop_reason": why})


def with_material(jobs: DataFrame) -> DataFrame:
    """(dialogue_id, scene, material): one row per job, its scene built from what was planned."""
    have = [F.col(c).cast("string").alias(c) if c in jobs.columns else F.lit(None).cast("string").alias(c) for c in MATERIAL]
    rows = jobs.select("dialogue_id", *have).dropDuplicates(["dialogue_id"]).withColumn("mode", F.coalesce("mode", F.lit("task")))
    goal = F.coalesce("goal", F.lit(GOAL))
    built = scene(F.col("mode"), F.coalesce("topic_name", F.lit("")), F.coalesce("seed_situation", F.lit("")), F.col("boundary"), goal)
    return rows.select("dialogue_id", built.alias("scene"), F.struct(*MATERIAL).alias("material"))


def append_rows(df: DataFrame, path: str) -> None:
    """More rows, those before untouched."""
    df.write.mode("append").parquet(path)


def event(df: DataFrame, name: str, detail) -> DataFrame:
    """K7: one event per row of ``df``."""
    return df.select("dialogue_id", F.current_timestamp().alias("at"), F.lit(name).alias("event"), detail.cast("string").alias("detail"))


def run_batch(
    jobs: DataFrame, folder: str, make: Callable[[], object] = Stub, max_rounds: int = 20, system: dict[str, str] | None = None, supersteps: int | None = None,
    audit: Callable[[dict], None] | None = None, progress: Callable[[str, str], None] | None = None,
) -> DataFrame:
    """Runs the jobs (dialogue_id and ``MATERIAL``) to their end, or for so many supersteps; the turns.

    A dialogue whose turn fails rests for this run, with the failure recorded, and goes on with the next one.
    """
    spark = jobs.sparkSession
    system = system or SYSTEM
    where = f"{folder}/turns"
    if not exists(spark, where):
        spark.createDataFrame([], TURN).write.parquet(where)
    scratch = Scratch(spark, "runner")
    material = scratch.table(with_material(jobs))
    fresh = material.select("dialogue_id", "scene")
    if exists(spark, f"{folder}/scenes"):
        fresh = fresh.join(spark.read.parquet(f"{folder}/scenes").select("dialogue_id"), "dialogue_id", "left_anti")
    fresh = scratch.table(fresh)
    append_rows(fresh, f"{folder}/scenes")
    append_rows(event(fresh, "scene", F.col("scene.conversation_mode")), f"{folder}/events")
    asked_of = material.select("dialogue_id", *[actor_system(system[a], a, F.col("scene"), F.col("material")).alias(a) for a in ("user", "character")])
    asked_of = scratch.table(asked_of)
    stored = spark.read.schema(TURN).parquet(where).dropDuplicates(["dialogue_id", "pos"])
    begun = asked_of.select("dialogue_id").join(state_of(stored, max_rounds), "dialogue_id", "left")
    state = begun.where("stop_reason IS NULL").select(
        "dialogue_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("said", F.array().cast("array<struct<speaker:string,content:string>>")).alias("said"),
        F.coalesce("flags", F.expr("cast(map() as map<int,boolean>)")).alias("flags"), F.coalesce("next", F.lit("user")).alias("next"),
    )
    state, at = scratch.keep(state)
    for _ in range(supersteps if supersteps is not None else 2 * max_rounds):
        parts = []
        for actor, check in (("user", backend.user_reply), ("character", backend.plain_reply)):
            rows = state.where(F.col("next") == actor).join(asked_of.select("dialogue_id", F.col(actor).alias("system")), "dialogue_id")
            asked = rows.withColumn("messages", actor_messages(F.col("system"), F.col("said"), actor, OPENING, F.col("flags")))
            parts.append(complete_rows(asked, actor, make, keep=("dialogue_id", "n"), check=check, audit=audit, progress=progress).withColumn("speaker", F.lit(actor)))
        got, got_at = scratch.keep(parts[0].unionByName(parts[1]))
        object_ = F.from_json(F.regexp_extract("reply", r"(?s)\{.*\}", 0), "message string, goal_completed boolean")
        user = F.col("speaker") == "user"
        new = got.where("reply IS NOT NULL").select(
            "dialogue_id", F.col("n").cast("int").alias("pos"), "speaker", F.when(user, object_["message"]).otherwise(F.col("reply")).alias("content"), F.when(user, object_["goal_completed"]).alias("goal_completed")
        )
        # the turns come last: a run broken off before them asks again, after them it does not
        append_rows(got.select("dialogue_id", F.explode("attempts").alias("a")).select("dialogue_id", "a.*"), f"{folder}/attempts")
        append_rows(got.where("reply IS NULL").select("dialogue_id", F.col("speaker").alias("phase"), "error", F.current_timestamp().alias("at")), f"{folder}/failures")
        turn = F.struct("speaker", "content")
        grown = state.join(new, "dialogue_id").select(
            "dialogue_id", (F.col("n") + 1).alias("n"), F.concat("said", F.array(turn)).alias("said"),
            F.when(user, F.map_concat("flags", F.map_from_arrays(F.array((F.floor(F.col("pos") / 2) + 1).cast("int")), F.array(F.coalesce("goal_completed", F.lit(False)))))).otherwise(F.col("flags")).alias("flags"),
        )
        grown, grown_at = scratch.keep(_judged(grown, max_rounds))
        done = F.expr("cast(n div 2 as int)")
        told = event(got.where("reply IS NULL"), "failed", F.col("error")).unionByName(event(grown.where("n % 2 = 1"), "user", done + 1)).unionByName(event(grown.where("n % 2 = 0"), "round", done))
        append_rows(told.unionByName(event(grown.where("stop_reason IS NOT NULL"), "end", F.col("stop_reason"))), f"{folder}/events")
        append_rows(new, where)
        if progress:
            progress("superstep", f"{grown.count()} turns")
        old = (at, got_at)
        state, at = scratch.keep(grown.where("stop_reason IS NULL").select("dialogue_id", "n", "said", "flags", "next"))
        for path in (*old, grown_at):
            scratch.drop(path)
        if state.isEmpty():
            break
    return spark.read.schema(TURN).parquet(where).dropDuplicates(["dialogue_id", "pos"])


def write_json(spark: SparkSession, path: str, value) -> None:
    """K1, K4: a small document, whole or not at all."""
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def export_jsonl(records: DataFrame, path: str, one_file: bool = False) -> None:
    """K3: training records as JSON lines; one file only where that is asked for."""
    out = records.select(F.col("dialogue_id").alias("id"), "messages")
    (out.coalesce(1) if one_file else out).write.mode("overwrite").json(path)
