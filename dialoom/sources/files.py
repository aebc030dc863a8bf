"""File scans: JSON documents, directories, catalogues, logs, CSV; everything declarative."""

from __future__ import annotations

import json
import os
import re
from decimal import Decimal
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = "\ufeff"


def json_documents(spark: SparkSession, path: str, glob: str = "*.json", schema: str | None = None) -> DataFrame:
    """Whole JSON documents of a directory, one row each, with ``file_name``.

    A byte order mark is tolerated. With a schema the documents are parsed by it, else ``doc`` is
    the text as VARIANT. The scan is not recursive and has no order; sort by ``file_name``.
    """
    text = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", False).text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), F.regexp_replace("value", f"^{BOM}", "").alias("raw"))
    )
    if schema:
        return text.withColumn("doc", F.from_json("raw", schema))
    return text.withColumn("doc", F.try_parse_json("raw"))


USER_FIELDS = "profiles array<struct<id:string,source_row_index:int,persona:string,speech_style:string,identity:string,life_stage:string,communication_style:string,interests:array<string>,knowledge:array<string>,habits:array<string>,tags:array<string>>>, version string, format string"
TOPIC_FIELDS = "id string, name string, version string, source string, dailydialog_source string, subtopics array<struct<id:string,name:string,mode:string,boundary:string,seeds:array<string>>>"
PRESET_FIELDS = "schema_version string, presets array<struct<id:string,tone:string>>"
TRANSCRIPT_FIELDS = "messages array<struct<role:string,content:string>>, scene struct<conversation_mode:string,background:string,relationship:string,trigger:string,facts:array<string>,boundary:string>, conversation_start struct<mode:string,topic:string,goal:string>, user_goal string, user_behavior struct<id:string,tone:string>, completed_at string, scores map<string,array<struct<dimension:string,score:int,reason:string>>>, average_score double"


def users(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """S3: user catalogue, one row per profile."""
    docs = json_documents(spark, path, glob, USER_FIELDS)
    return docs.select("doc.version", F.explode("doc.profiles").alias("p")).select("p.*", "version")


def topics(spark: SparkSession, path: str, glob: str = "topic_*.json") -> DataFrame:
    """Topic groups flattened to subtopics with the columns of their group."""
    docs = json_documents(spark, path, glob, TOPIC_FIELDS).select("doc.*")
    return flatten_groups(docs)


def flatten_groups(groups: DataFrame) -> DataFrame:
    """One row per subtopic with group id, name, version and source."""
    return groups.select(
        F.explode("subtopics").alias("s"), F.col("id").alias("group_id"), F.col("name").alias("group_name"), "version", "source"
    ).select("s.*", "group_id", "group_name", "version", "source")


def characters(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """S3: characters; the id is the file stem, the profile stays open, the version is a digest."""
    from dialoom.functions.json_text import canonical_digest

    docs = json_documents(spark, path, glob)
    name = F.coalesce(*[F.expr(f"nullif(try_variant_get(doc, '{p}', 'string'), '')") for p in ("$.name", "$.Name")])
    return docs.select(
        F.regexp_replace("file_name", r"\.json$", "").alias("id"), name.alias("name"), F.col("raw").alias("profile"),
        canonical_digest(F.col("raw")).alias("version"), F.col("file_name").alias("source"),
        F.coalesce(F.expr("try_variant_get(doc, '$.compatibility_tags', 'array<string>')"), F.array().cast("array<string>")).alias("tags"),
    )


def presets(spark: SparkSession, path: str, selection: str = "random") -> DataFrame:
    """Behaviour presets; ``random`` keeps all, an id keeps one and must exist."""
    rows = json_documents(spark, os.path.dirname(path), os.path.basename(path), PRESET_FIELDS).select(F.explode("doc.presets").alias("p")).select("p.*")
    if selection == "random":
        return rows
    one = rows.where(F.col("id") == selection)
    if one.isEmpty():
        names = [r.id for r in rows.select("id").orderBy("id").take(51)]
        raise ValueError(f"unknown preset {selection}; available: {', '.join(names[:50])}{' and more' if len(names) > 50 else ''}")
    return one


def sampling_config(path_or_doc: str | dict, axes: dict[str, tuple[str, ...]]) -> dict[str, dict[str, Decimal]]:
    """Weights per axis in canonical key order, checked exactly."""
    from dialoom.operators.quota import checked_weights

    doc = path_or_doc if isinstance(path_or_doc, dict) else json.loads(Path(path_or_doc).read_text(encoding="utf-8-sig"))
    if set(doc) != {"schema_version", *(f"{a}_distribution" for a in axes)}:
        raise ValueError("unexpected or missing fields")
    return {a: checked_weights(doc[f"{a}_distribution"], keys) for a, keys in axes.items()}


def transcripts(spark: SparkSession, path: str, glob: str = "dialogue_*.json") -> DataFrame:
    """Transcripts with ``dialogue_id``, the file stem."""
    docs = json_documents(spark, path, glob, TRANSCRIPT_FIELDS)
    return docs.select(F.regexp_replace("file_name", r"\.json$", "").alias("dialogue_id"), "doc.*")


def progress_logs(spark: SparkSession, path: str, glob: str = "*.progress.log") -> DataFrame:
    """Progress logs in either form: a JSON object with ``events``, or plain lines."""
    text = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    raw = F.regexp_replace("value", f"^{BOM}", "")
    parsed = F.from_json(raw, "format_version string, events array<string>, character_name string")
    lines = F.filter(F.split(raw, "\r\n|[\n\r]"), lambda x: x != "")
    return text.select(
        F.regexp_replace("_metadata.file_name", r"\.progress\.log$", "").alias("dialogue_id"),
        F.when(F.ltrim(raw).startswith("{"), parsed["events"]).otherwise(lines).alias("events"),
        parsed["character_name"].alias("character_name"),
    )


def job_ids(logs: DataFrame, manifests: DataFrame) -> DataFrame:
    """Distinct ids of both, in string order."""
    return logs.select("dialogue_id").union(manifests.select("dialogue_id")).distinct().orderBy("dialogue_id")


def persona_csv(spark: SparkSession, path: str) -> DataFrame:
    """Persona rows with blank ones dropped and ``source_row_index``, counted over the data rows of all files by name.

    A file is one split (quoted fields hold line breaks), so the place in it is the distance from
    its first row; where each file begins comes from one row per file.
    """
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    named = rows.columns
    rows = rows.select("*", F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__at"))
    per = rows.groupBy("__file").agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    begins = per.select("__file", "__low", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    at = (F.col("__at") - F.col("__low") + F.col("__before")).cast("int")
    rows = rows.join(begins, "__file").select(*[F.col(f"`{c}`") for c in named], at.alias("source_row_index"))
    persona = F.col(f"`{named[0]}`")
    return rows.where(persona.isNotNull() & F.regexp_like(persona, F.lit(r"(?U)\S")))


def resolve_data_path(path: str, legacy: dict[str, str]) -> str:
    """The path itself if it exists, else the same path under a directory it moved to."""
    if os.path.exists(path):
        return path
    for old, new in legacy.items():
        if path.startswith(old) and os.path.exists(new + path[len(old):]):
            return new + path[len(old):]
    return path


def read_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines; the process environment wins; no interpolation; driver only."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8-sig").splitlines() if os.path.exists(path) else []:
        m = re.match(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            out[m[1]] = m[2].strip("'\"")
    return out | {k: v for k, v in os.environ.items() if k in out}


def prompt_templates(folder: str) -> dict[str, str]:
    """The system and user templates of a folder."""
    return {name: (Path(folder) / f"{name}.txt").read_text(encoding="utf-8").strip() for name in ("system", "user")}


# Fixed values (S14): ids and principle names of the seven dimensions, as stored scores use them; the wording of the criteria is this project's own.
RUBRIC = [
    ("style_consistency", "风格一致", "Does the reply keep the character's way of speaking?"),
    ("trait_consistency", "特质一致", "Does the reply show the character's traits and beliefs?"),
    ("emotion_expression", "情感表达", "Does the reply take up the user's mood, neither too strongly nor too weakly?"),
    ("coherence", "连贯性", "Does the reply follow from the dialogue so far?"),
    ("naturalness", "自然性", "Does the reply sound like a person and not like a template?"),
    ("topic_management", "话题推动", "Does the reply go on, deepen or close the topic as the moment asks?"),
    ("boundary_compliance", "禁忌红线遵守", "Does the reply respect the limits set for the character?"),
]


def rubric(spark: SparkSession) -> DataFrame:
    """(ord, dimension_id, principle, criterion), seven rows."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(RUBRIC)], "ord int, dimension_id string, principle string, criterion string")

