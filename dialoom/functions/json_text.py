"""JSON as text: canonical form and digest (F1), tolerant parsing of model output.

Spark's JSON functions neither sort keys nor reject trailing text, so these two run as Arrow
UDFs; everything else about JSON stays with ``from_json`` and VARIANT.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.session import ship_package


def canonical(value) -> str:
    """Sorted keys, plain separators, no escapes."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def digest_of(value) -> str:
    return hashlib.sha256(canonical(value).encode("utf-8", "surrogatepass")).hexdigest()


@F.pandas_udf(T.StringType())
def _digests(text: pd.Series) -> pd.Series:
    def one(t):
        try:
            return digest_of(json.loads(t)) if t is not None else None
        except ValueError:
            return None

    return text.map(one)


def canonical_digest(c: Column) -> Column:
    """the SHA-256 of the canonical form of JSON text; null for null or broken text."""
    ship_package(SparkSession.active())
    return _digests(c)


def tolerant_object(text: str | None):
    """the one JSON object of a model's reply, or None.

    Accepted are a bare object, one in a fence, and one in prose that holds no bracket before it
    and no bracket or brace after it. Anything else, two objects included, is refused.
    """
    if text is None:
        return None
    body = text.strip().lstrip("﻿")
    if body[:3] == "```" and body[-3:] == "```" and len(body) >= 6:
        inner = body[3:-3]
        body = (inner[4:] if inner[:4].lower() == "json" else inner).strip()
    try:
        value = json.loads(body)
        return value if isinstance(value, dict) else None
    except ValueError:
        pass
    start = body.find("{")
    if start <= 0 or "[" in body[:start]:
        return None
    try:
        value, end = json.JSONDecoder().raw_decode(body, start)
    except ValueError:
        return None
    return value if isinstance(value, dict) and not set(body[end:]) & set("{}[]") else None


@F.pandas_udf(T.StringType())
def _objects(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if (v := tolerant_object(t)) is None else canonical(v))


def tolerant_json(c: Column) -> Column:
    """F3 as a column: the object in canonical form, null where it is refused."""
    ship_package(SparkSession.active())
    return _objects(c)
