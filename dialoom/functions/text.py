"""Text functions as column expressions (all inside code generation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line breaks as Python's splitlines sees them.
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"


def strip(c: Column) -> Column:
    """All Unicode blanks at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """runs of blanks become one, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def display_name(c: Column) -> Column:
    """what stands before the first wide opening bracket and the first semicolon."""
    return strip(F.substring_index(F.substring_index(c, "（", 1), ";", 1))


def split_lines(c: Column) -> Column:
    """lines, without an empty one at the end."""
    parts = F.split(c, LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


# The rewrites of the fact normaliser, in order.
FACT_REWRITES = (
    (r"\bi m\b", "i am"),
    (r"\bi ve\b", "i have"),
    (r"\bi d\b", "i would"),
    (r"\bi ll\b", "i will"),
    (r"\bdon t\b", "do not"),
    (r"\bdoesn t\b", "does not"),
    (r"\bdidn t\b", "did not"),
    (r"\bcan t\b", "can not"),
    (r"\bwon t\b", "will not"),
    (r"\bparent s\b", "parents"),
    (r"\bparents s\b", "parents"),
    (r"\brecently started to work\b", "recently started working"),
    (r"\bfriends do not call my by\b", "friends do not call me by"),
)


def normalize_fact(c: Column, keep: str = "a-z0-9") -> Column:
    """one form of a fact. ``keep`` is the class of characters that count as its text.

    The default is for English facts; for facts in any language pass ``\\p{L}\\p{N}``.
    """
    out = F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("cannot"), F.lit("can not")), f"[^{keep}]+", " "))
    for pattern, to in FACT_REWRITES:
        out = F.regexp_replace(out, pattern, to)
    return out


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """F8: ``$name`` fields filled by columns in one concat, so values are never searched again."""
    import re

    parts: list[Column] = []
    at = 0
    for m in re.finditer(r"\$(?:(\$)|(\w+)|\{(\w+)\})", template):
        parts.append(F.lit(template[at : m.start()]))
        parts.append(F.lit("$") if m[1] else values[m[2] or m[3]].cast("string"))
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def sample_id(dialogue: Column, round_: Column) -> Column:
    """``<dialogue>:round_02``."""
    return F.format_string("%s:round_%02d", dialogue, round_)


def task_id(sample: Column, dimension: Column, principle: Column) -> Column:
    """``<sample>:<dimension>:<principle>``."""
    return F.concat_ws(":", sample, dimension, principle)


def id_number(c: Column, prefix: str = "dialogue_") -> Column:
    """The number of a whole id, null for anything else."""
    return F.when(F.regexp_like(c, F.lit(rf"^{prefix}\d+$")), F.regexp_extract(c, r"(\d+)$", 1).cast("bigint"))


def visible_length_between(c: Column, low: int = 85, high: int = 115) -> Column:
    """whether the length without line breaks lies within the bounds."""
    return F.length(F.regexp_replace(c, "\n", "")).between(low, high)


def any_line_starts(c: Column, prefix: str) -> Column:
    """F14."""
    return F.exists(split_lines(c), lambda x: x.startswith(prefix))


def error_window(c: Column, at: Column, width: int = 24) -> Column:
    """the text around a position with everything but JSON syntax hidden."""
    start = F.greatest(at - width, F.lit(0))
    return F.regexp_replace(F.substring(c, start + 1, at + width - start), r"[^{}\[\]:,\"\\\s]", "x")


def embedded_json(c: Column) -> Column:
    """from the first brace to the end, as VARIANT; null if there is none."""
    at = F.instr(c, "{")
    return F.when(at > 0, F.try_parse_json(F.substring(c, at, F.length(c))))


def mean_score(c: Column) -> Column:
    """F16: the mean of an aggregate, half-even at four places."""
    return F.bround(F.avg(c), 4)
