"""An extension: samples that arrive as files are scored as they come (Structured Streaming)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialoom.operators.backend import Stub, complete_rows, judge_reply
from dialoom.operators.scoring import pending_tasks, task_grid
from dialoom.session import Scratch, exists


def score_stream(spark: SparkSession, source: str, schema: str, dims: DataFrame, store: str, checkpoint: str, make: Callable[[], object] = Stub):
    """A query that scores new samples with every dimension and appends to the table ``store``.

    Each micro-batch scores only tasks without a stored score, so a repeated batch adds nothing. Failed
    and malformed replies go to the table ``<store>-failures``.
    """

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        tasks = task_grid(df, dims)
        done = spark.read.parquet(store).select("task_id") if exists(spark, store) else spark.createDataFrame([], "task_id string")
        prompt = F.concat_ws("\n", "principle", "model_response", F.format_string('{"%s": {"score": 1, 3 or 5, "reason": "..."}}', "principle"))
        asked = pending_tasks(tasks.dropDuplicates(["task_id"]), done).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))))
        replies = complete_rows(asked, "judge", make, keep=("task_id", "dialogue_id", "principle"), check=judge_reply, expect="principle")
        replies = Scratch(spark, "stream").table(replies)
        item = F.try_element_at(F.from_json(F.regexp_extract("reply", r"(?s)\{.*\}", 0), "map<string,struct<score:int,reason:string>>"), F.col("principle"))
        replies.where("reply IS NULL").select("task_id", "dialogue_id", "error").write.mode("append").parquet(f"{store}-failures")
        replies.where("reply IS NOT NULL").select("task_id", "dialogue_id", "principle", item["score"].alias("score"), item["reason"].alias("reason")).write.mode("append").parquet(store)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str = "ts", late: str = "10 minutes", width: str = "5 minutes", key: str = "event_type") -> DataFrame:
    """Counts per window and key over a stream with late rows."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
