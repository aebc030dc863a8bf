"""Joins of the catalogue and of stored state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import split_lines


def lookup(rows: DataFrame, catalogue: DataFrame, on: str, digest: str | None = None, stored: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(matched, problems). Each row needs a catalogue row, with the digest it remembers."""
    cat = catalogue.withColumn("__there", F.lit(True))
    joined = rows.join(cat, on, "left")
    why = F.when(F.col("__there").isNull(), "missing")
    if digest and stored:
        why = why.when(~F.col(digest).eqNullSafe(F.col(stored)), "changed")
    judged = joined.withColumn("problem", why).drop("__there")
    return judged.where("problem IS NULL").drop("problem"), judged.where("problem IS NOT NULL").select(on, "problem")


def restore(state: DataFrame, transcripts: DataFrame, logs: DataFrame, key: str = "dialogue_id") -> DataFrame:
    """State with its transcript, and its log if there is one."""
    return state.join(transcripts, key).join(logs, key, "left")


def select_intents(selection: DataFrame, services: DataFrame) -> DataFrame:
    """Chosen (service_name, intent) with the intent's row of its service."""
    intents = services.select("service_name", F.explode("intents").alias("i")).select("service_name", F.col("i.name").alias("intent"), F.col("i.description").alias("description"))
    return selection.join(intents, ["service_name", "intent"], "left")


def translate_lines(profiles: DataFrame, translations: DataFrame, id_col: str = "source_row_index", text: str = "persona") -> tuple[DataFrame, DataFrame]:
    """(profiles with every line translated in order, lines without a translation)."""
    lines = profiles.select(id_col, F.posexplode(split_lines(F.col(text))).alias("at", "line"))
    joined = lines.join(translations.select(F.col("source").alias("line"), "target"), "line", "left")
    ordered = F.array_sort(F.collect_list(F.struct("at", "target")))
    whole = joined.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda x: x["target"]), "\n").alias("translated"), F.count_if(F.col("target").isNull()).alias("missing"))
    return whole.where("missing = 0").drop("missing"), joined.where("target IS NULL").select(id_col, "line")


def union_same_schema(parts: list[DataFrame], key: str) -> DataFrame:
    """Tables of one schema (names and types in order) put together; ids must stay unique."""
    kinds = {tuple(p.dtypes) for p in parts}
    if len(kinds) > 1:
        raise ValueError("the tables differ in columns or types")
    out = reduce(DataFrame.unionByName, parts)
    if not out.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{key} repeats")
    return out
