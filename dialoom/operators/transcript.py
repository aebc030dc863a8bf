"""Turns of dialogues: pairs, shape, history, prompts, review transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialoom.functions.labels import role_key


def turns(messages: DataFrame) -> DataFrame:
    """Redelivered messages once, roles in one spelling.

    Copies meet by dialogue and position, reduced before the shuffle to the smallest role and
    text, so neither many redeliveries nor a long dialogue make a hot task, and copies that
    differ give the same row on every run.
    """
    rows = messages.select("dialogue_id", "pos", role_key(F.col("role")).alias("role"), "content")
    return rows.groupBy("dialogue_id", "pos").agg(F.min("role").alias("role"), F.min("content").alias("content"))


def public_turns(t: DataFrame) -> DataFrame:
    """User and assistant turns numbered ``i`` from 0, with ``round``."""
    w = Window.partitionBy("dialogue_id").orderBy("pos")
    rows = t.where(F.col("role").isin("user", "assistant")).withColumn("i", (F.row_number().over(w) - 1).cast("int"))
    return rows.withColumn("round", (F.floor(F.col("i") / 2) + 1).cast("int"))


def shape(t: DataFrame) -> DataFrame:
    """Per dialogue what is wrong with its shape, as flags, and ``ok``.

    A system header comes first; then user and assistant alternate, in full pairs, with no blank
    content. One aggregation, no sort: the parity is that of the position.
    """
    odd = F.col("pos") % 2 == 1
    body = F.col("pos") > 0
    agreed = F.when(odd, F.col("role") == "user").otherwise(F.col("role") == "assistant")
    blank = F.col("content").isNull() | ~F.regexp_like(F.coalesce("content", F.lit("")), F.lit(r"(?U)\S"))
    out = t.groupBy("dialogue_id").agg(
        F.coalesce(F.bool_or((F.col("pos") == 0) & (F.col("role") == "system")), F.lit(False)).alias("has_header"),
        F.coalesce(F.bool_and(F.when(body, agreed)), F.lit(False)).alias("alternates"),
        (F.count_if(body) % 2 == 0).alias("complete"),
        F.coalesce(F.bool_or(body & blank), F.lit(False)).alias("has_blank"),
        (F.coalesce(F.max("pos"), F.lit(-1)) + 1 == F.count("*")).alias("gapless"),
        F.count_if(body).alias("n_messages"),
    )
    ok = F.col("has_header") & F.col("alternates") & F.col("complete") & ~F.col("has_blank") & F.col("gapless") & (F.col("n_messages") > 0)
    return out.withColumn("ok", ok)


def require_shape(t: DataFrame, strict: bool = True) -> DataFrame:
    """Dialogues of a good shape; with ``strict`` a bad one is an error, named."""
    bad = shape(t).where("NOT ok")
    if strict:
        first = bad.orderBy("dialogue_id").select("dialogue_id").first()
        if first:
            raise ValueError(f"broken dialogue {first.dialogue_id}")
    return t.join(bad.select("dialogue_id"), "dialogue_id", "left_anti")


def pairs(t: DataFrame) -> DataFrame:
    """(dialogue_id, round, user, assistant) of all complete pairs."""
    # the order of the numbering, so that one sort serves both windows
    w = Window.partitionBy("dialogue_id").orderBy("pos")
    rows = public_turns(t).withColumns({"next_role": F.lead("role").over(w), "assistant": F.lead("content").over(w)})
    return rows.where("i % 2 = 0 AND role = 'user' AND next_role = 'assistant'").select("dialogue_id", "round", F.col("content").alias("user"), "assistant")


def rounds(t: DataFrame) -> DataFrame:
    """Number of complete pairs."""
    return t.where(F.col("role").isin("user", "assistant")).groupBy("dialogue_id").agg(F.expr("count(*) div 2").alias("rounds"))


def pending(t: DataFrame) -> DataFrame:
    """(dialogue_id, message_count, pending_message) where the count is odd."""
    rows = t.where(F.col("role").isin("user", "assistant")).groupBy("dialogue_id").agg(F.count("*").alias("message_count"), F.max_by(F.struct("content"), "pos").alias("m"))
    return rows.where("message_count % 2 = 1").select("dialogue_id", "message_count", F.col("m.content").alias("pending_message"))


def reply_samples(t: DataFrame) -> DataFrame:
    """One row per reply with ``history``, all turns before it (its user turn included).

    One array per dialogue and a slice of it per reply, cut as the rows stream by.
    """
    said = F.array_sort(F.collect_list(F.struct("pos", "role", "content")))
    per = t.where(F.col("role").isin("user", "assistant")).groupBy("dialogue_id").agg(said.alias("said")).where("size(said) > 1")
    rows = per.withColumn("round", F.explode(F.expr("sequence(1, cast(size(said) div 2 as int))")))
    before = F.transform(F.slice("said", F.lit(1), 2 * F.col("round") - 1), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return rows.select("dialogue_id", "round", before.alias("history"), F.element_at("said", 2 * F.col("round"))["content"].alias("model_response"))


def history_text(history: Column, names: tuple[str, str] = ("用户", "角色")) -> Column:
    """Numbered lines ``k. speaker：text``."""
    line = lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.when(x["role"] == "user", names[0]).otherwise(names[1]), F.lit("："), F.coalesce(x["content"], F.lit("")))
    return F.array_join(F.transform(history, line), "\n")


def perspective(turns_: Column, actor: str, flags: Column | None = None) -> Column:
    """Own turns become assistant turns, the other's user turns.

    For the user actor, own turns are re-encoded as JSON with the goal flag of their round
    (``flags``: MAP<round, BOOLEAN>; false where absent).
    """

    def one(x, i):
        content = x["content"]
        if actor == "user":
            flag = F.coalesce(F.try_element_at(flags, (F.floor(i / 2) + 1).cast("int")), F.lit(False)) if flags is not None else F.lit(False)
            content = F.when(x["speaker"] == "user", F.to_json(F.struct(x["content"].alias("message"), flag.alias("goal_completed")))).otherwise(content)
        return F.struct(F.when(x["speaker"] == actor, "assistant").otherwise("user").alias("role"), content.alias("content"))

    return F.transform(turns_, one)


def actor_messages(system: Column, turns_: Column, actor: str, opening: str, flags: Column | None = None) -> Column:
    """system message, the turns as the actor sees them, and an opener for an empty history."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    body = perspective(turns_, actor, flags)
    opener = F.when(F.size(turns_) == 0, F.array(message("user", F.lit(opening)))).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(F.array(message("system", system)), body, opener)


def actor_system(text: str, actor: str, scene_: Column, material: Column) -> Column:
    """the system message: the text, then what the actor may know, as JSON.

    ``material`` has user_profile, tone, character_name and character_profile. The user sees the
    public scene, its own profile, goal and tone, and of the character the name only; the character
    sees its profile and the scene without the mode and the user's goal.
    """
    public = scene_.dropFields("user_goal")
    if actor == "user":
        known = F.struct(
            material["user_profile"].alias("profile"), public.alias("scene"), scene_["user_goal"].alias("user_goal"), material["character_name"].alias("character_public_name"),
            F.struct(F.coalesce(material["tone"], F.lit("neutral")).alias("tone")).alias("user_behavior"),
            F.struct(scene_["conversation_mode"].alias("mode"), scene_["background"].alias("topic"), scene_["user_goal"].alias("goal")).alias("conversation_start"),
        )
    else:
        known = F.struct(material["character_profile"].alias("profile"), character_scene(public).alias("scene"))
    return F.concat(F.lit(text + "\n"), F.to_json(known, {"ignoreNullFields": "false"}))


def scene(mode: Column, topic: Column, seed: Column, boundary: Column, goal: Column) -> Column:
    """The scene of a conversation start; chat modes leave what they have not got null."""
    task, open_chat = mode == "task", mode == "open_chat"
    nothing = F.lit(None).cast("string")
    return F.struct(
        mode.alias("conversation_mode"),
        F.when(open_chat, nothing).otherwise(topic).alias("background"),
        F.lit("first contact").alias("relationship"),
        F.when(task, seed).otherwise(nothing).alias("trigger"),
        F.array().cast("array<string>").alias("facts"),
        F.when(task, F.coalesce(boundary, F.lit(""))).otherwise(F.lit("")).alias("boundary"),
        F.when(task, goal).otherwise(nothing).alias("user_goal"),
    )


def scene_valid(mode: Column, background: Column, trigger: Column, goal: Column) -> Column:
    """What must be there, and what must not, by mode."""
    there = lambda c: c.isNotNull() & F.regexp_like(F.coalesce(c, F.lit("")), F.lit(r"(?U)\S"))
    return (
        F.when(mode == "task", there(background) & there(trigger) & there(goal))
        .when(mode == "topic_chat", there(background) & trigger.isNull() & goal.isNull())
        .when(mode == "open_chat", background.isNull() & trigger.isNull() & goal.isNull())
        .otherwise(F.lit(False))
    )


def mode_of(start_mode: Column, scene_mode: Column) -> Column:
    """The mode of the start unless it is null or empty, else that of the scene."""
    return F.coalesce(F.nullif(start_mode, F.lit("")), scene_mode)


def character_name(state: Column, profile: Column, catalogue: bool = False) -> Column:
    """The two orders of precedence, over a VARIANT profile."""
    named = lambda path: F.nullif(F.try_variant_get(profile, path, "string"), F.lit(""))
    inner, outer = named("$['角色基本信息'].Name"), named("$.name")
    return F.coalesce(outer, inner, state) if catalogue else F.coalesce(F.nullif(state, F.lit("")), inner, outer, F.lit("character"))


def review_transcript(t: DataFrame, scenes: DataFrame) -> DataFrame:
    """Header and complete pairs as one array per dialogue, joined with its scene."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "role", "content"))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    per = t.groupBy("dialogue_id").agg(ordered.alias("messages"))
    whole = F.when(F.size("messages") % 2 == 0, F.slice("messages", 1, F.size("messages") - 1)).otherwise(F.col("messages"))
    return per.select("dialogue_id", whole.alias("messages")).join(scenes, "dialogue_id")


def stop_reasons(goal: Column, n_rounds: Column, max_rounds: int = 20) -> Column:
    """Both reasons in order of priority; an empty array means go on."""
    return F.array_compact(F.array(F.when(goal, F.lit("user_goal_completed")), F.when(n_rounds >= max_rounds, F.lit("max_turns"))))


def masked_turns(t: DataFrame) -> DataFrame:
    """flat training rows; ``loss_mask`` is 1 for replies only."""
    return t.select("dialogue_id", "pos", "role", F.coalesce("content", F.lit("")).alias("content"), (F.col("role") == "assistant").cast("int").alias("loss_mask"))


def training_rows(t: DataFrame) -> DataFrame:
    """One record per dialogue, its messages in order of position."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "role", "content", "loss_mask")))
    fields = F.transform(ordered, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["loss_mask"].alias("loss_mask")))
    return masked_turns(t).groupBy("dialogue_id").agg(fields.alias("messages"))


def training_export(records: DataFrame) -> DataFrame:
    """The first record in id order of each distinct message list.

    Grouping is by a fingerprint and keeps only the smallest id, so equal records meet as numbers,
    partially aggregated, and a dialogue that occurs millions of times is no hot group.
    """
    print_ = F.sha2(F.to_json("messages"), 256)
    first = records.groupBy(print_.alias("fp")).agg(F.min("dialogue_id").alias("dialogue_id"))
    return records.join(first.select("dialogue_id"), "dialogue_id", "left_semi")


def judge_view(t: DataFrame, scenes: DataFrame) -> DataFrame:
    """What the judge may see: roles, contents and the public scene, nothing else."""
    public = ["dialogue_id", *[c for c in ("conversation_mode", "background", "relationship", "trigger", "facts", "boundary") if c in scenes.columns]]
    return reply_samples(t.select("dialogue_id", "pos", "role", "content")).join(scenes.select(*public), "dialogue_id")


def user_view(users: DataFrame, behaviours: DataFrame) -> DataFrame:
    """The profile without its communication style, and of the behaviour only its tone.

    A missing tone is neutral, as in snapshots written before there were tones.
    """
    shown = [c for c in users.columns if c != "communication_style"]
    return users.select(*shown).join(behaviours.select("id", F.coalesce("tone", F.lit("neutral")).alias("tone")), "id", "left")


def character_scene(scene_: Column) -> Column:
    """The public scene without the mode."""
    return scene_.dropFields("conversation_mode")


# The project's own wording; the fields are those of a judge's request.
JUDGE_TEMPLATE = "Dimension $dimension_name: $criterion\nScenario $scenario: $context\nCharacter: $character\nDialogue so far:\n$history\nReply to score:\n$model_response\nAnswer with one JSON object: {\"$principle\": {\"score\": 1, 3 or 5, \"reason\": \"...\"}}"


def judge_prompts(samples: DataFrame, template: str = JUDGE_TEMPLATE) -> DataFrame:
    """(task_id, prompt) from tasks that hold the template's fields."""
    from dialoom.functions.text import fill_template

    return samples.select("task_id", fill_template(template, {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in samples.columns if c != "task_id"}).alias("prompt"))


def iso_time(c: Column) -> Column:
    """a timestamp as ISO 8601 text in UTC."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def close_round(state: DataFrame, max_rounds: int = 20) -> DataFrame:
    """State (dialogue_id, messages, goal) after a full round: reasons, status and next phase."""
    n = F.expr("size(messages) div 2")
    why = stop_reasons(F.coalesce("goal", F.lit(False)), n, max_rounds)
    over = F.size(why) > 0
    full = (F.size("messages") > 0) & (F.size("messages") % 2 == 0)
    return state.where(full).select(
        "dialogue_id", n.alias("rounds"), why.alias("stop_reasons"), F.try_element_at(why, F.lit(1)).alias("stop_reason"),
        F.when(over, "completed").otherwise("running").alias("status"), F.when(over, "done").otherwise("user").alias("phase"),
    )


def reset_rejected(jobs: DataFrame) -> DataFrame:
    """A job that was rejected before anything was said begins anew with its scene; all others stay as they are."""
    before = F.col("phase").isin("scene", "scene_review")
    again = F.coalesce((F.col("phase") == "scene_review") | (before & F.col("status").isin("incompatible", "rejected")), F.lit(False))
    return jobs.withColumns({"status": F.when(again, "pending").otherwise(F.col("status")), "phase": F.when(again, "scene").otherwise(F.col("phase"))})
