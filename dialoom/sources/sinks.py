"""Writers of catalogues, transcripts and logs (K2, K6, K8, K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_catalogue(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """K8: a catalogue as Parquet or JSON lines; the old one is replaced by the committer at once."""
    if kind not in ("parquet", "json"):
        raise ValueError("parquet or json")
    getattr(df.write.mode("overwrite"), kind)(path)


def transcript_documents(records: DataFrame, scenes: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """K2, K9: (dialogue_id, value): the JSON document of each dialogue, rendered from the tables.

    ``records`` has the message arrays, ``scenes`` one row per dialogue, ``scores`` the nested scores.
    """
    rows = records.join(scenes, "dialogue_id")
    if scores is not None:
        rows = rows.join(scores, "dialogue_id", "left")
    body = F.struct(*[c for c in rows.columns if c != "dialogue_id"])
    return rows.select("dialogue_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_transcripts(documents: DataFrame, path: str) -> None:
    """K2: documents as text lines in files by dialogue hash; a rendering is never the store."""
    documents.select(F.pmod(F.xxhash64("dialogue_id"), F.lit(64)).alias("part"), "value").write.mode("overwrite").partitionBy("part").text(path)


def upsert_scores(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new scores together; a contradiction is an error before any write."""
    from dialoom.operators.scoring import merge_scores

    merged, clash = merge_scores(stored, new)
    first = clash.first()
    if first:
        raise ValueError(f"{first.task_id}: stored {first.score}, new {first.new_score}")
    return merged
