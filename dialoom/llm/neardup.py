"""Problem 3: near-duplicate texts (odd sketches of MinHash samples, banded candidates).

1. Texts with equal letters are one class; only its smallest id goes on.
2. The shingles of a text are its distinct runs of ``k`` letters. ``ROUNDS`` one-permutation
   hashings give ``SAMPLES`` MinHash samples.
3. Bands of ``rows`` samples are hashed; two texts with an equal band are a candidate pair.
4. Odd sketches fold the samples into bitmaps of parities. The population count of the XOR of two
   sketches estimates the similarity; pairs that it puts clearly below the threshold (``MARGIN``
   standard deviations) are dropped, first by the one sketch, then by both.
5. What is left is checked exactly on the shingle sets.

A pair of similarity s is a candidate with probability 1 - (1 - s^rows)^(SAMPLES // rows): with
the default of 5 rows 0.994 at s = 0.6, 0.9997 at 0.65 and 0.99998 at 0.7. Buckets have no cap:
an equi-join on the band with adaptive skew splitting takes large ones, and ``groups`` makes no
pairs within texts that are already linked.

The first four steps move 64-bit numbers only; texts are moved once to build the documents and
again only for texts that are in a surviving pair.

Defined cases: null parts are dropped; texts with fewer than ``k`` letters have no shingles and
are near no other text; exact copies are pairs of similarity 1 if they have shingles; repeated
rows of one id count once (the smallest text); null ids are left out; empty tables give an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.letters import batch_letters, mix, starts_within, window_hashes
from dialoom.session import Scratch, ship_package

ROUNDS, BINS = 4, 80
SAMPLES = ROUNDS * BINS
#: Two odd sketches of so many bits, samples folded into each, standard deviations of tolerance.
SKETCHES, SKETCH_BITS, FOLDED, MARGIN = 2, 512, SAMPLES // 2, 4.0
_WORDS = SKETCH_BITS // 64
_CHUNK_LETTERS = 300_000


def minhash_samples(codes: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(texts, SAMPLES) 64-bit samples, and which texts have shingles at all."""
    n = len(off) - 1
    start, doc = starts_within(off, k)
    has = np.zeros(n, bool)
    out = np.zeros((n, SAMPLES), np.uint64)
    if not len(start):
        return out, has
    has[doc] = True
    h = window_hashes(codes, tuple(range(k)))[start]
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    for r in range(ROUNDS):
        g = mix(h ^ np.uint64(0x9E3779B97F4A7C15 * (r + 1) & 0xFFFFFFFFFFFFFFFF))
        part = ((g >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        flat = np.full(n * BINS, empty)
        np.minimum.at(flat, doc * BINS + part.astype(np.int64), g * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1))
        m = flat.reshape(n, BINS)
        # an empty bin borrows from the next filled one, at a distance that enters the value
        gone = (m == empty) & has[:, None]
        source = m.copy()
        for step in range(1, BINS):
            if not gone.any():
                break
            lent = np.roll(source, -step, axis=1)
            fill = gone & (lent != empty)
            m[fill] = mix(lent[fill] + np.uint64(step))
            gone &= ~fill
        out[:, r * BINS : (r + 1) * BINS] = m
    return out, has


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key per band, the number of the band hashed in."""
    bands = SAMPLES // rows
    x = samples[:, : bands * rows].reshape(len(samples), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), x.shape[:2]).copy()
    for i in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + x[:, :, i])
    return h.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(texts, words) the parity bitmaps, each of its own FOLDED samples."""
    n = len(samples)
    out = []
    for k in range(SKETCHES):
        part = samples[:, k * FOLDED : (k + 1) * FOLDED]
        place = mix(part + np.arange(1, FOLDED + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(SKETCH_BITS)
        flat = (np.arange(n)[:, None] * SKETCH_BITS + place.astype(np.int64)).ravel()
        odd = (np.bincount(flat, minlength=n * SKETCH_BITS) & 1).astype(np.uint8).reshape(n, SKETCH_BITS)
        out.append(np.packbits(odd, axis=1, bitorder="little").view(np.uint64).view(np.int64))
    return np.concatenate(out, axis=1)


def largest_distance(threshold: float, sketches: int = 1) -> int:
    """The population count of XORs above which a pair is clearly below the threshold."""
    differ = 2 * FOLDED * (1 - threshold)
    mean = SKETCH_BITS / 2 * (1 - math.exp(-2 * differ / SKETCH_BITS))
    sampling = 2 * math.sqrt(FOLDED * threshold * (1 - threshold)) * math.exp(-2 * differ / SKETCH_BITS)
    folding = math.sqrt(SKETCH_BITS / 4 * (1 - math.exp(-4 * differ / SKETCH_BITS)))
    return math.ceil(sketches * mean + math.sqrt(sketches) * MARGIN * math.hypot(sampling, folding))


def shingle_set(text: str, k: int) -> set[str]:
    return {text[i : i + k] for i in range(len(text) - k + 1)}


def signatures(parts: DataFrame, k: int, rows: int) -> DataFrame:
    """From (id, place, part) one row per id with letters, class key, bands and sketch.

    One shuffle by id; each task streams through its sorted partition.
    """
    ship_package(parts.sparkSession)
    bands = SAMPLES // rows
    schema = T.StructType(
        [T.StructField("id", parts.schema["id"].dataType), T.StructField("letters", T.StringType()), T.StructField("n", T.IntegerType())]
        + [T.StructField(x, T.LongType()) for x in ("c1", "c2", *(f"s{i}" for i in range(SKETCHES * _WORDS)))]
        + [T.StructField("bands", T.ArrayType(T.LongType()))]
    )

    def rows_of(ids: list, texts: list[str], id_type) -> pa.RecordBatch:
        import xxhash

        codes, off = batch_letters(texts)
        samples, has = minhash_samples(codes, off, k)
        keep = np.flatnonzero(has)
        keys, sketch = band_keys(samples[keep], rows), odd_sketches(samples[keep])
        text = [codes[off[i] : off[i + 1]].tobytes().decode("utf-32-le", "surrogatepass") for i in keep]
        d = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in text]
        c = np.frombuffer(b"".join(d), dtype="<i8").reshape(-1, 2) if d else np.zeros((0, 2), np.int64)
        ends = pa.array(np.arange(len(keep) + 1, dtype=np.int32) * bands)
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i in keep], id_type), pa.array(text, pa.string()), pa.array(np.diff(off)[keep].astype(np.int32)), pa.array(c[:, 0]), pa.array(c[:, 1])]
            + [pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCHES * _WORDS)]
            + [pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, id_type = [], [], 0, None
        now, place, pieces = None, None, []
        for b in batches:
            id_type = b.schema.field(0).type
            for i, p, t in zip(*(c.to_pylist() for c in b.columns)):
                if i != now:
                    if now is not None:
                        ids.append(now)
                        texts.append("\n".join(pieces))
                        size += len(texts[-1])
                        if size > _CHUNK_LETTERS:
                            yield rows_of(ids, texts, id_type)
                            ids, texts, size = [], [], 0
                    now, place, pieces = i, None, []
                if p != place:
                    place = p
                    pieces.append(t)
        if now is not None:
            yield rows_of([*ids, now], [*texts, "\n".join(pieces)], id_type)

    ordered = parts.where("id IS NOT NULL AND part IS NOT NULL").select("id", "place", "part").repartition("id").sortWithinPartitions("id", "place", "part")
    return ordered.mapInArrow(run, schema)


class NearDuplicates:
    """Classes of equal texts and verified pairs between their representatives.

    ``members``: (id, rep) for every text with shingles. ``pairs``: (a, b, similarity) of
    representatives, a < b. ``groups`` finds the classes of linked texts without making all pairs.
    """

    def __init__(self, parts: DataFrame, k: int = 5, threshold: float = 0.8, rows: int = 5):
        self.k, self.threshold, self.idt = k, threshold, parts.schema["id"].dataType
        self.scratch = Scratch(parts.sparkSession, "near-duplicates")
        # an exact number stands for each id while pairs are made
        signed = self.scratch.table(signatures(parts, k, rows).withColumn("x", F.xxhash64(F.monotonically_increasing_id())))
        reps = signed.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
        named = signed.select("id", "x", "c1", "c2").join(reps, ["c1", "c2"]).select("id", "x", "rep")
        named = self.scratch.table(named)
        self.members = named.select("id", "rep")
        # copies are mostly few: written down, Spark knows their size and need not move all texts to drop them
        copies = self.scratch.table(named.where("id <> rep").select("x"))
        self.lone = signed.join(copies, "x", "left_anti")
        self.banded = self.lone.select("x", F.explode("bands").alias("band"))
        self._pairs: DataFrame | None = None

    def verified(self, candidates: DataFrame) -> DataFrame:
        """Of pairs of numbers (x, y) those that are near: first by the sketches, then exactly; (x, y, a, b, similarity)."""
        lone, k, threshold = self.lone, self.k, self.threshold

        def with_distance(pairs: DataFrame, which: int) -> DataFrame:
            """Pairs that come with the distance ``d`` so far, and that of one more sketch added."""
            at = range(which * _WORDS, (which + 1) * _WORDS)
            one = lone.select("x", *[F.col(f"s{i}") for i in at])
            two = lone.select(F.col("x").alias("y"), *[F.col(f"s{i}").alias(f"t{i}") for i in at])
            d = F.col("d")
            for i in at:
                d = d + F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"t{i}")))
            return pairs.join(one, "x").join(two, "y").select("x", "y", d.alias("d"))

        close = candidates.withColumn("d", F.lit(0))
        for which in range(SKETCHES):
            close = with_distance(close, which).where(F.col("d") <= largest_distance(threshold, which + 1))
        close = self.scratch.table(close.select("x", "y"))
        text = lone.select("x", "id", "letters")
        in_pair = close.select("x").union(close.select(F.col("y").alias("x"))).distinct()
        text = text.join(in_pair, "x", "left_semi")
        both = close.join(text.select("x", F.col("id").alias("ia"), F.col("letters").alias("la")), "x").join(
            text.select(F.col("x").alias("y"), F.col("id").alias("ib"), F.col("letters").alias("lb")), "y"
        )
        numbers = [T.StructField("x", T.LongType()), T.StructField("y", T.LongType())]
        schema = T.StructType([*numbers, T.StructField("a", self.idt), T.StructField("b", self.idt), T.StructField("similarity", T.DoubleType())])

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                last, second = None, set()
                for x, y, ia, la, ib, lb in zip(*(c.to_pylist() for c in b.columns)):
                    if ib != last:  # the join leaves equal ones together
                        last, second = ib, shingle_set(lb, k)
                    first = shingle_set(la, k)
                    common = len(first & second)
                    union = len(first) + len(second) - common
                    if common >= threshold * union - 1e-9:
                        out.append((x, y, min(ia, ib), max(ia, ib), common / union))
                t = b.schema.field(2).type
                kinds = (pa.int64(), pa.int64(), t, t, pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names=schema.names)

        return self.scratch.table(both.select("x", "y", "ia", "la", "ib", "lb").mapInArrow(check, schema))

    @property
    def pairs(self) -> DataFrame:
        if self._pairs is None:
            other = self.banded.withColumnRenamed("x", "y")
            candidates = self.banded.join(other, "band").where("x < y").select("x", "y").distinct()
            self._pairs = self.verified(candidates).select("a", "b", "similarity")
        return self._pairs

    def all_pairs(self) -> DataFrame:
        """(a, b) of ids, copies expanded: work and rows in proportion to the result."""
        m = self.members
        one, two = m.select(F.col("id").alias("ia"), F.col("rep").alias("a")), m.select(F.col("id").alias("ib"), F.col("rep").alias("b"))
        across = self.pairs.join(one, "a").join(two, "b").select("ia", "ib")
        within = one.join(two.withColumnRenamed("b", "a"), "a").where("ia < ib").select("ia", "ib")
        return across.unionByName(within).select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"))

    def groups(self) -> DataFrame:
        """(id, group_id, group_size): one row per text that is nearly the same as another.

        A bucket's texts are linked as ``bucket_links`` does it, so a large group of texts all near
        each other makes no pairs within.
        """
        from dialoom.operators.components import connected_components
        from dialoom.operators.stars import bucket_links

        links = bucket_links(self.banded, self.verified, self.scratch).select("a", "b")
        group = connected_components(links, "a", "b").select(F.col("node").alias("rep"), "component")
        rows = self.members.join(group, "rep", "left").select("id", F.coalesce("component", "rep").alias("group_id"))
        rows = self.scratch.table(rows)
        sizes = rows.groupBy("group_id").agg(F.count("*").alias("group_size")).where("group_size > 1")
        return rows.join(sizes, "group_id").select("id", "group_id", "group_size")
