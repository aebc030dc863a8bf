"""Constraint checks: predicates as columns, violations as DataFrames."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nonblank(c: Column) -> Column:
    """Text with something to see."""
    return F.coalesce(F.regexp_like(c, F.lit(r"(?U)\S")), F.lit(False))


def text_list(c: Column, nonempty: bool = True) -> Column:
    """A list of such texts."""
    every = F.coalesce(F.forall(c, nonblank), F.lit(False))
    return every & (F.size(c) > 0) if nonempty else every


def strict_bool(text: Column, key: str) -> Column:
    """The value of a JSON boolean; null for "false", 1 and anything else."""
    return F.from_json(text, f"`{key}` boolean")[key]


def exact_keys(text: Column, keys: list[str]) -> Column:
    """Whether JSON text is an object with exactly these keys."""
    return F.coalesce(F.array_sort(F.json_object_keys(text)) == F.array(*[F.lit(k) for k in sorted(keys)]), F.lit(False))


def within(c: Column, domain: list) -> Column:
    """P5."""
    return F.coalesce(c.isin(*domain), F.lit(False))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def holds_forbidden(text: Column, keys: tuple[str, ...] = ("goal", "scene", "topic", "goal_completed")) -> Column:
    """Whether a JSON object has one of these keys."""
    return F.coalesce(F.arrays_overlap(F.json_object_keys(text), F.array(*[F.lit(k) for k in keys])), F.lit(False))


def point(df: DataFrame, col: str, value: str, suffix: str = "") -> DataFrame:
    """The row of an id (a suffix does not matter); an unknown one is an error that names some."""
    one = df.where(F.col(col) == (value.removesuffix(suffix) if suffix else value))
    if one.isEmpty():
        names = [str(r[0]) for r in df.select(col).distinct().orderBy(col).take(51)]
        raise ValueError(f"unknown {col} {value}; available: " + ", ".join(names[:50]) + (" and more" if len(names) > 50 else ""))
    return one


def finished(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """P10: (kept, skipped) by status."""
    good = within(F.col(status), ["completed", "accepted"])
    return df.where(good), df.where(~good)


def in_modes(df: DataFrame, modes: list[str] | None, col: str = "mode") -> DataFrame:
    """Any of these modes; none given keeps all."""
    return df.where(F.col(col).isin(*modes)) if modes else df


def violations(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """(id, rule) of every rule a row breaks; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    return df.select(id_col, F.explode(broken).alias("rule"))


def require(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """The rows, after a check that all of them keep the rules."""
    first = violations(df, id_col, rules).first()
    if first:
        raise ValueError(f"{first[0]}: {first[1]}")
    return df


def user_rules() -> dict[str, Column]:
    """S3: the rules of a raw persona."""
    return {"id": nonblank(F.col("id")), "persona": nonblank(F.col("persona"))}


def structured_user_rules() -> dict[str, Column]:
    """S3: the rules of a structured user."""
    lists = {c: text_list(F.col(c)) for c in ("interests", "knowledge", "habits", "tags")}
    return {"id": nonblank(F.col("id")), "identity": nonblank(F.col("identity")), "life_stage": nonblank(F.col("life_stage"))} | lists


def topic_rules(modes: list[str]) -> dict[str, Column]:
    """S3: the rules of a subtopic."""
    return {"id": nonblank(F.col("id")), "name": nonblank(F.col("name")), "mode": within(F.col("mode"), modes), "seeds": text_list(F.col("seeds"))}


def client_settings(config: dict, judge: bool = False) -> dict:
    """Exactly the known fields; timeouts, retries, spacing; endpoints by names of environment variables, no secret inline.

    A judge's settings have the block ``judge`` in place of ``models``, with a JSON mode, a limit
    of tokens and a temperature.
    """
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v)
    limits = (("timeout_seconds", 1, 3600), ("retries", 0, 8), ("min_interval_seconds", 0, 3600))
    block = "judge" if judge else "models"
    unknown = set(config) - {k for k, _, _ in limits} - {block}
    if unknown:
        raise ValueError(f"unknown settings {', '.join(sorted(unknown))}")
    for key, low, high in limits:
        if not number(config.get(key)) or not low <= config[key] <= high:
            raise ValueError(f"{key} must be a number from {low} to {high}")
    ends = {"judge": config.get("judge")} if judge else config.get("models", {})
    for name, end in ends.items():
        if isinstance(end, str) and not judge:
            continue
        if not isinstance(end, dict):
            raise ValueError(f"{name} needs an endpoint")
        if {"api_key", "authorization"} & {str(k).lower() for k in end}:
            raise ValueError("keys belong into the environment")
        for key in ("base_url_env", "model_env", "api_key_env") if judge else ():
            if not isinstance(end.get(key), str) or not end[key].strip():
                raise ValueError(f"{name} needs {key}")
        if type(end.get("json_mode", True)) is not bool:
            raise ValueError("json_mode must be a boolean")
        if type(end.get("max_tokens", 2000)) is not int or end.get("max_tokens", 2000) <= 0:
            raise ValueError("max_tokens must be a positive integer")
        if not number(end.get("temperature", 0)) or not 0 <= end.get("temperature", 0) <= 2:
            raise ValueError("temperature must be a number from 0 to 2")
    return config


def all_of(*columns: Column) -> Column:
    """The conjunction, false where a part is null."""
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in columns])
