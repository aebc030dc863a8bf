"""Column functions that bring unevenly written labels, roles and ids to one key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FULL = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))


def label_key(c: Column) -> Column:
    """Case, width, blanks, invisible characters and separators do not matter."""
    return F.lower(F.regexp_replace(F.translate(c, _FULL, _HALF), r"[^\p{L}\p{N}]+", ""))


def id_key(c: Column) -> Column:
    """As label_key, for ids: a directory, a ``.json`` ending and leading zeros do not matter."""
    plain = F.lower(F.regexp_replace(F.translate(c, _FULL, _HALF), r"[^\p{L}\p{N}/\\.]+", ""))
    stem = F.regexp_replace(F.regexp_replace(plain, r"^.*[/\\]", ""), r"\.json$", "")
    return F.regexp_replace(F.regexp_replace(stem, r"\.", ""), r"(?<![0-9])0+(?=[0-9])", "")


def role_key(c: Column) -> Column:
    """``user``, ``assistant``, ``system`` or the folded text; ``character`` means assistant."""
    k = label_key(c)
    return F.when(k == "character", F.lit("assistant")).otherwise(k)
