"""Problem 7: passages of evaluation items inside a corpus (spaced-seed hashing).

Fixed masks look at some positions of a window of letters and ignore the others, so a hit
survives substituted letters at ignored places. Both texts are first brought to the form in which
they read to the eye (see ``uniform``).

1. The seeds of all items, one for each mask and place, go into a table.
2. A filter of bits is made from that table by an aggregation: ``bits_per_seed`` bits for a seed,
   at most 2 ** ``most_bits`` (64 MB), so what is broadcast has a bound whatever the number of
   items. Beyond it the filter lets more through; nothing is lost.
3. One pass over the documents, whatever the number of items, hashes every window of every text in
   Arrow batches and keeps the seeds that pass the filter; a document without any ends here.
4. What is left is joined with the items' seeds on the hash, and brought down to one row for each
   document, item and diagonal (the distance between the two places).
5. On each diagonal the two texts are compared letter by letter: the longest run of equal letters
   and the longest substitution-tolerant overlap.

Items never pass through the driver. Any exact run of at least ``SPAN`` letters holds a whole
window, so no case is missed as long as the least run asked for is that long (smaller ones raise
ValueError).

Defined cases: null or blank texts on either side leak nothing; an item with fewer letters than
its least run cannot leak; repeated item ids count once (the first text in string order);
repeated document rows give their result once; empty tables give an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.letters import batch_letters, slices, starts_within
from dialoom.llm.uniform import Uniform, uniform_text
from dialoom.session import Scratch, ship_package, spread

# The masks; 1 is a position that counts.
MASKS = ("111100010010011011000011", "101000001110110001101011", "101110100010011100101001")
SPAN = len(MASKS[0])
_POSITIONS = tuple(tuple(i for i, x in enumerate(m) if x == "1") for m in MASKS)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Letters hashed at a time, so that the arrays stay in the processor's cache.
_CHUNK = 1 << 17
#: Bits that a seed sets in the filter.
PROBES = 4


def seed_hashes(codes: np.ndarray, mask: int) -> np.ndarray:
    """The hash of the counted letters for each window start."""
    n = len(codes) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    h = np.full(n, mask + 1, np.uint64)
    for p in _POSITIONS[mask]:
        h *= _BASE
        h += c[p : p + n]
    h = (h ^ (h >> np.uint64(29))) * _BASE
    return h ^ (h >> np.uint64(32))


class Filter:
    """Bits of seeds: everything that was put in passes, and little else."""

    def __init__(self, words: np.ndarray):
        """words: 64-bit words, a power of two of them."""
        self.bytes = words.view(np.uint8)
        self.mask = np.uint64(len(words) * 64 - 1)

    def passes(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that pass."""
        at = None
        one, two = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        for i in range(PROBES):
            slot = (one + np.uint64(i) * two) & self.mask
            hit = (self.bytes[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
            kept = np.flatnonzero(hit)
            at = kept if at is None else at[kept]
            one, two = one[kept], two[kept]
        return at


def filter_words(seeds: DataFrame, bits_per_seed: int, most_bits: int) -> np.ndarray:
    """The filter of a table of seeds ``h``, aggregated by word: at most 2 ** most_bits bits."""
    distinct = seeds.select("h").distinct()
    bits = min(most_bits, max(12, (distinct.count() * bits_per_seed - 1).bit_length()))
    one, two = F.shiftrightunsigned("h", 32), F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
    slots = F.array(*[(one + F.lit(i) * two).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(PROBES)])
    by_word = distinct.select(F.explode(slots).alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask"))
    table = by_word.toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[table.column("word").to_numpy()] = table.column("mask").to_numpy()
    return words.view(np.uint64)


def longest_runs(same: np.ndarray, penalty: int = 4) -> tuple[int, int, int]:
    """Longest run of equal letters; length and substitutions of the best tolerant overlap.

    The tolerant overlap is the stretch with the highest score, an equal letter counting 1 and
    a substituted one minus ``penalty``.
    """
    n = len(same)
    if not n:
        return 0, 0, 0
    off = np.flatnonzero(np.concatenate(([True], ~same, [True])))
    exact = int(np.diff(off).max()) - 1
    s = np.concatenate(([0], np.cumsum(np.where(same, 1, -penalty))))
    low = np.minimum.accumulate(s)
    end = int(np.argmax(s - low))
    start = int(np.argmin(s[: end + 1])) if end else 0
    return exact, end - start, int((~same[start:end]).sum())


def overlap(a: np.ndarray, b: np.ndarray, diagonals: list[int]) -> tuple[int, int, int]:
    """Longest exact run, longest tolerant overlap and its substitutions, on any of the diagonals.

    The exact run and the overlap, that with fewest substitutions, may lie on different ones.
    """
    exact, best = 0, (0, 0)
    for k in diagonals:
        i, j = max(0, k), max(0, -k)
        n = min(len(a) - i, len(b) - j)
        run, length, subs = longest_runs(a[i : i + n] == b[j : j + n])
        exact, best = max(exact, run), max(best, (length, -subs))
    return exact, best[0], -best[1]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def item_letters(items: DataFrame, item_id: str, text: str, least: dict[str, int], default: int, lang: str | None) -> DataFrame:
    """``(item, letters, least)``: one row per item with a text."""
    if min([default, *least.values()]) < SPAN:
        raise ValueError(f"a least run below {SPAN} letters can be missed by the masks")
    cols = [F.col(item_id).alias("i"), F.col(text).alias("t"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("l")]
    rows = items.select(*cols).where("t IS NOT NULL AND i IS NOT NULL").groupBy("i").agg(F.min(F.struct("t", "l")).alias("r")).select("i", "r.t", "r.l")
    run = F.lit(default)
    for name, n in least.items():
        run = F.when(F.col("l") == name, F.lit(n)).otherwise(run)
    uniform = uniform_text(rows.select(F.col("i").alias("item"), "t", run.alias("least")), "t", "u", readable=False)
    schema = T.StructType([T.StructField("item", items.schema[item_id].dataType), T.StructField("letters", T.StringType()), T.StructField("least", T.IntegerType())])

    def only_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, off = batch_letters(b.column(1).to_pylist())
            text = [codes[x:y].tobytes().decode("utf-32-le", "surrogatepass") for x, y in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), b.column(2)], names=schema.names)

    return uniform.select("item", "u", "least").mapInArrow(only_letters, schema)


def item_seeds(letters: DataFrame) -> DataFrame:
    """``(item, h, at)``: the seeds of every place."""
    schema = T.StructType([letters.schema["item"], T.StructField("h", T.LongType()), T.StructField("at", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 1):
                codes, off = batch_letters(b.column(1).to_pylist())
                start, row = starts_within(off, SPAN)
                for m in range(len(MASKS) if len(start) else 0):
                    h = seed_hashes(codes, m)[start]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(h.view(np.int64)), pa.array((start - off[row]).astype(np.int32))], names=schema.names)

    return letters.select("item", "letters").mapInArrow(run, schema)


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    lang: str | None = "lang",
    least: dict[str, int] | None = None,
    default_least: int = 60,
    bits_per_seed: int = 96,
    most_bits: int = 29,
) -> DataFrame:
    """Rows (doc, item, ``exact_letters``, ``overlap_letters``, ``substitutions``, ``min_letters``).

    A row comes out if the longest exact run or the tolerant overlap has the least run's length.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "leakage")
    known = scratch.table(item_letters(items, item_id, item_text, {"zh": 30} if least is None else least, default_least, lang))
    seeds = scratch.table(item_seeds(known))
    shared = spark.sparkContext.broadcast(filter_words(seeds, bits_per_seed, most_bits))
    ids = docs.schema[doc_id].dataType
    hit = T.StructType([T.StructField("doc", ids), T.StructField("letters", T.StringType()), T.StructField("hs", T.ArrayType(T.LongType())), T.StructField("places", T.ArrayType(T.IntegerType()))])

    def seeds_of(codes: np.ndarray, off: np.ndarray, table: Filter) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of all seeds that pass, by place."""
        pos, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo in range(0, max(0, len(codes) - SPAN + 1), _CHUNK):
            part = codes[lo : lo + _CHUNK + SPAN - 1]
            for m in range(len(MASKS)):
                h = seed_hashes(part, m)
                at = table.passes(h)
                pos.append(at + lo)
                found.append(h[at])
        p, h = np.concatenate(pos), np.concatenate(found)
        order = np.argsort(p, kind="stable")
        return p[order], h[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, uniform = Filter(shared.value), Uniform()
        for whole in batches:
            for b in slices(whole, 1, 1_000_000):
                codes, off = batch_letters(uniform(b.column(1)).to_pylist())
                pos, h = seeds_of(codes, off, table)
                doc = np.searchsorted(off, pos, "right") - 1
                inside = pos + SPAN <= off[doc + 1]
                pos, h, doc = pos[inside], h[inside], doc[inside]
                rows, first = np.unique(doc, return_index=True)
                if not len(rows):
                    continue
                ends = pa.array(np.concatenate((first, [len(doc)])).astype(np.int32))
                letters = [codes[off[i] : off[i + 1]].tobytes().decode("utf-32-le", "surrogatepass") for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(letters, pa.string()), pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array((pos - off[doc]).astype(np.int32)))],
                    names=hit.names,
                )

    source = spread(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).where("t IS NOT NULL AND id IS NOT NULL"))
    hits = scratch.table(source.mapInArrow(run, hit).withColumn("row", F.monotonically_increasing_id()))
    one = hits.select("row", F.explode(F.arrays_zip("hs", "places")).alias("s")).select("row", F.col("s.hs").alias("h"), F.col("s.places").alias("place"))
    met = one.join(seeds, "h").select("row", "item", (F.col("place") - F.col("at")).alias("diagonal")).distinct()
    met = met.groupBy("row", "item").agg(F.collect_list("diagonal").alias("diagonals"))
    both = met.join(known.withColumnRenamed("letters", "theirs"), "item").join(hits.select("row", "doc", "letters"), "row")
    schema = T.StructType(
        [T.StructField(doc_id, ids), T.StructField(item_id, items.schema[item_id].dataType)]
        + [T.StructField(x, T.IntegerType()) for x in ("exact_letters", "overlap_letters", "substitutions", "min_letters")]
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2, 4_000_000):
                keep, found = [], []
                for i, (letters, theirs, diagonals, n) in enumerate(zip(*(b.column(c).to_pylist() for c in range(2, 6)))):
                    exact, length, subs = overlap(_codes(letters), _codes(theirs), diagonals)
                    if max(exact, length) >= n:
                        keep.append(i)
                        found.append((exact, length, subs, n))
                if keep:
                    at = pa.array(keep)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *[pa.array(x, pa.int32()) for x in zip(*found)]], names=schema.names)

    return both.select("doc", "item", "letters", "theirs", "diagonals", "least").mapInArrow(verify, schema).distinct()
