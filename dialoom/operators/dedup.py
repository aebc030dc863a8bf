"""Profiles that say the same: facts, overlaps, components, representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialoom.functions.text import normalize_fact, split_lines
from dialoom.operators.components import connected_components
from dialoom.operators.stars import bucket_links
from dialoom.session import Scratch


def facts(profiles: DataFrame, id_col: str, text: Column, keep: str = "a-z0-9") -> DataFrame:
    """(id, fact): the distinct normalised lines of each text; a line of marks only counts as ''."""
    lines = F.array_distinct(F.transform(split_lines(text), lambda x: normalize_fact(x, keep)))
    return profiles.select(F.col(id_col).alias("id"), F.explode(lines).alias("fact")).distinct()


def fact_classes(f: DataFrame) -> DataFrame:
    """(id, rep): every profile with the smallest one of exactly its facts."""
    whole = f.groupBy("id").agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_set("fact"))), 256).alias("print"))
    rep = whole.groupBy("print").agg(F.min("id").alias("rep"))
    return whole.join(rep, "print").select("id", "rep")


def _ordered_sets(f: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, fs, n) of representatives: their shared facts from the rarest on, and the number of all."""
    counts = f.groupBy("fact").agg(F.count("*").alias("df"))
    one = f.join(reps, "id", "left_semi")
    shared = one.join(counts.where("df > 1"), "fact").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "fact"))), lambda x: x["fact"]).alias("fs"))
    return shared.join(one.groupBy("id").agg(F.count("*").alias("n")), "id")


def _key(*xs: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *xs), 256)


def _pairs_of(fs: Column) -> Column:
    """All (i, j), i < j, of places in an array."""
    idx = F.sequence(F.lit(1), F.size(fs))
    return F.flatten(F.transform(F.slice(idx, F.lit(1), F.greatest(F.size(fs) - 1, F.lit(0))), lambda i: F.transform(F.slice(idx, i + 1, F.size(fs)), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def _buckets(rows: DataFrame) -> DataFrame:
    """(x, band): two profiles that share three facts share a band.

    The two rarest of their common facts are not the last of either profile in the order from
    rare to frequent, so pairs of facts without the most frequent one of each profile are enough:
    half the square of the facts, and a fact in a third of all profiles opens no bucket alone.
    """
    early = rows.where(F.size("fs") >= 3).select("id", F.slice("fs", F.lit(1), F.size("fs") - 1).alias("fs"))
    each = early.select("id", "fs", F.explode(_pairs_of(F.col("fs"))).alias("p"))
    return each.select(F.col("id").alias("x"), _key(F.element_at("fs", F.col("p.i")), F.element_at("fs", F.col("p.j"))).alias("band"))


def _held(rows: DataFrame) -> DataFrame:
    """(holder, small): profiles of one or two facts, and those that hold all of these."""
    few = rows.where((F.col("n") <= 2) & (F.col("n") == F.size("fs")))
    small = few.select(F.col("id").alias("small"), F.when(F.col("n") == 1, _key(F.lit("1"), F.element_at("fs", 1))).otherwise(_key(F.lit("2"), F.array_min("fs"), F.array_max("fs"))).alias("k"))
    # only the facts of small profiles can be such keys
    of_small = few.select(F.explode("fs").alias("fact")).distinct()
    flat = rows.select("id", F.explode("fs").alias("fact")).join(of_small, "fact", "left_semi").groupBy("id").agg(F.array_sort(F.collect_list("fact")).alias("gs"))
    ones = flat.select("id", F.explode("gs").alias("g")).select("id", _key(F.lit("1"), F.col("g")).alias("k"))
    twos = flat.select("id", "gs", F.explode(_pairs_of(F.col("gs"))).alias("p")).select("id", _key(F.lit("2"), F.element_at("gs", F.col("p.i")), F.element_at("gs", F.col("p.j"))).alias("k"))
    return ones.unionByName(twos).join(small, "k").where("id <> small").select(F.col("id").alias("holder"), "small")


def _common(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (x, y) with ``common``, the number of facts they share."""
    one, two = rows.select(F.col("id").alias("x"), F.col("fs").alias("f")), rows.select(F.col("id").alias("y"), F.col("fs").alias("g"))
    return pairs.join(one, "x").join(two, "y").select("x", "y", F.size(F.array_intersect("f", "g")).cast("bigint").alias("common"))


def overlap_pairs(f: DataFrame, strong: int = 3) -> DataFrame:
    """(a, b, common) with a < b that share three facts, or one of which holds the other.

    Pairs are those between representatives of equal sets of facts (``fact_classes`` has the
    members), so copies make no pairs.
    """
    if strong != 3:
        raise ValueError("sets of three only")
    scratch = Scratch(f.sparkSession, "overlaps")
    reps = fact_classes(f).where("id = rep").select("id")
    rows = scratch.table(_ordered_sets(f, reps))
    met = _buckets(rows)
    candidates = met.join(met.withColumnRenamed("x", "y"), "band").where("x < y").select("x", "y").distinct()
    strong_pairs = _common(candidates, rows).where("common >= 3")
    held = _common(_held(rows).select(F.least("holder", "small").alias("x"), F.greatest("holder", "small").alias("y")).distinct(), rows)
    return strong_pairs.unionByName(held).select(F.col("x").alias("a"), F.col("y").alias("b"), "common").distinct()


def overlap_edges(f: DataFrame, strong: int = 3) -> DataFrame:
    """Edges (src, dst) with the components of ``overlap_pairs``, without all of its pairs."""
    if strong != 3:
        raise ValueError("sets of three only")
    scratch = Scratch(f.sparkSession, "overlaps")
    classes = scratch.table(fact_classes(f))
    rows = scratch.table(_ordered_sets(f, classes.where("id = rep").select("id")))
    links = bucket_links(_buckets(rows), lambda c: scratch.table(_common(c, rows).where("common >= 3").select("x", "y")), scratch)
    edges = links.select(F.col("x").alias("src"), F.col("y").alias("dst")).union(_held(rows)).union(classes.where("id <> rep"))
    return edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))


def profile_groups(f: DataFrame) -> DataFrame:
    """(id, component) of every profile, single ones included; the component is its smallest id."""
    grouped = connected_components(overlap_edges(f)).withColumnRenamed("node", "id")
    return f.select(F.col("id").cast("string").alias("id")).distinct().join(grouped, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def representatives(groups: DataFrame, f: DataFrame, order: DataFrame) -> DataFrame:
    """Per component the profile with the most facts, then the smallest ``ord``."""
    sizes = f.groupBy(F.col("id").cast("string").alias("id")).agg(F.count("*").alias("n"))
    rows = groups.join(sizes, "id").join(order, "id", "left")
    best = F.min_by("id", F.struct(-F.col("n"), F.coalesce("ord", F.lit(2**31 - 1)), F.col("id")))
    return rows.groupBy("component").agg(best.alias("id"), F.count("*").alias("members"))


def ordered_fold(profiles: DataFrame, order: str, id_col: str, text: str, limit: int = 50, keep: str = "a-z0-9") -> DataFrame:
    """The incremental variant, row by row in order until ``limit`` distinct ones.

    The result depends on all rows before, so it is sequential by definition. Rows stream to the
    driver one at a time and only the kept ones, at most ``limit``, stay there. ``keep`` is as in
    ``facts``.
    """
    spark = profiles.sparkSession
    lines = F.array_distinct(F.transform(split_lines(F.col(text)), lambda x: normalize_fact(x, keep)))
    kept: list[tuple[int, object, frozenset]] = []
    for r in profiles.select(F.col(order).alias("o"), F.col(id_col).alias("i"), lines.alias("fs")).where("fs IS NOT NULL").orderBy("o").toLocalIterator():
        new = (r.o, r.i, frozenset(r.fs))
        alike = [k for k in kept if len(k[2] & new[2]) >= 3 or k[2] <= new[2] or new[2] <= k[2]]
        best = max([*alike, new], key=lambda k: (len(k[2]), -k[0]))
        kept = sorted([k for k in kept if k not in alike] + [best], key=lambda k: k[0])
        if len(kept) >= limit:
            break
    return spark.createDataFrame([(o, i) for o, i, _ in kept], f"ord {profiles.schema[order].dataType.simpleString()}, id {profiles.schema[id_col].dataType.simpleString()}")
