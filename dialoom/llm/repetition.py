"""Problem 5: repetition inside a single text (hashed n-gram logistic regression).

The exact measure: in the letters of a text, a letter is repeated if it lies in a run of ``run``
consecutive letters that also begins at an earlier place; the share is repeated letters over
letters. ``repeated_share`` gives it for every row.

``repetition_scores`` scores every row in Arrow batches with a logistic regression on hashed
word 1- to 3-grams and character 5- and 10-grams. The feature of an n-gram is its number of
occurrences after the first over all n-grams of its order; its weight is that of the order plus
that of its hash bucket. The model is fitted on at most ``train_rows`` rows, chosen by a hash of
the text and labelled by the exact measure, with rows made from a quarter of them, whole and in
hash order, that reach the threshold by the least possible number of repeated places; it is
calibrated by Platt's method on a held-out part. ``prevailing`` keeps the rows above a fixed low probability and checks these
exactly. If the sample holds no rows at all, every row is checked.

Rows made for the fit hold the necessary condition at its limit: half of the letters can only be
repeated if a twentieth of the runs begin earlier (for runs of 10), so a true case never has less
of the feature than rows the model was taught to keep.

Defined cases: a null text has no letters and the share 0; a text shorter than ``run`` has the
share 0; rows are independent, so repeated rows get equal results; empty tables give an empty
result; further columns are kept, except one with the name of an output column, which is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialoom.llm.letters import alnum_table, batch_letters, slices, starts_within, window_hashes
from dialoom.session import ship_package, spread

ORDERS = ("char5", "char10", "word1", "word2", "word3")
BUCKETS = 1 << 12
#: Rows with at least this calibrated probability are checked exactly.
CANDIDATE = 0.01
_HASH_BITS = np.uint64(44)
_LOW = np.uint64((1 << 44) - 1)


def exact_shares(codes: np.ndarray, off: np.ndarray, run: int = 10) -> np.ndarray:
    """The share of repeated letters of each text."""
    n = np.diff(off)
    share = np.zeros(len(n))
    start, doc = starts_within(off, run)
    if not len(start):
        return share
    h = window_hashes(codes, tuple(range(run)))[start]
    order = np.lexsort((start, h, doc))
    again = np.zeros(len(order), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    at = start[order[again]]
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + run, -1)
    repeated = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    has = n > 0
    share[has] = (repeated[off[1:]] - repeated[off[:-1]])[has] / n[has]
    return share


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word (an unbroken run of letters), and offsets of the texts."""
    joined = "\x00".join([t.replace("\x00", " ") if t else "" for t in texts]).lower() + "\x00"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    keep = alnum_table()[cp]
    first = np.flatnonzero(keep & ~np.concatenate(([False], keep[:-1])))
    ends = np.flatnonzero(cp == 0)
    off = np.concatenate(([0], np.searchsorted(first, ends)))
    if not len(first):
        return np.zeros(0, np.uint64), off
    last = np.flatnonzero(keep & ~np.concatenate((keep[1:], [False]))) + 1
    # sum of mixed (letter, place in word), so that order within the word counts
    begin = np.zeros(len(cp), np.int64)
    begin[first] = first
    place = np.arange(len(cp)) - np.maximum.accumulate(begin)
    v = (cp.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))
    v ^= v >> np.uint64(31)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(v, dtype=np.uint64)))
    return total[last] - total[first], off


def repeats(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts and buckets of all occurrences after the first, and occurrences by text."""
    total = np.bincount(doc, minlength=n_docs)
    key = (doc.astype(np.uint64) << _HASH_BITS) | (h >> np.uint64(20))
    key.sort()
    again = key[1:][key[1:] == key[:-1]]
    return (again >> _HASH_BITS).astype(np.int64), ((again & _LOW) % np.uint64(BUCKETS)).astype(np.int64), total


def features(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order the sparse features: text, bucket, value (one entry per repeated occurrence)."""
    n = len(texts)
    codes, off = batch_letters(texts)
    words, word_off = word_hashes(texts)
    out = []
    for order in ORDERS:
        k = int(order[4:])
        c, o = (codes, off) if order.startswith("char") else (words, word_off)
        start, doc = starts_within(o, k)
        if not len(start):
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)))
            continue
        h = window_hashes(c, tuple(range(k)))[start]
        row, bucket, total = repeats(h, doc, n)
        out.append((row, bucket, 1.0 / np.maximum(total, 1)[row]))
    return out


@dataclass
class Model:
    """Weights by order and by bucket, bias, and the two numbers of the calibration."""

    order: np.ndarray
    bucket: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, feats, n: int) -> np.ndarray:
        z = np.full(n, self.bias)
        for k, (row, bucket, value) in enumerate(feats):
            if len(row):
                z += np.bincount(row, weights=(self.order[k] + self.bucket[k, bucket]) * value, minlength=n)
        return z

    def probability(self, texts: list[str | None]) -> np.ndarray:
        z = self.slope * self.margin(features(texts), len(texts)) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def at_the_limit(text: str, rng: np.random.Generator, run: int, share: float) -> str:
    """A text that reaches ``share`` by scattered single runs, the weakest form of a case."""
    letters = [c for c in text if c.isalnum()]
    while len(letters) < 2 * run:
        letters += letters or list("0123456789")
    # half of the result repeats runs of the first half, each once, in another order
    body = "".join(letters)
    pieces = [body[i : i + run] for i in range(0, len(body) - run + 1, run)]
    need = int(np.ceil(share / (1 - share) * len(body) / run)) + 1
    picks = [pieces[i] for i in rng.permutation(len(pieces))[: min(need, len(pieces))]]
    return body + " " + " ".join(picks)


def _text_hash(text: str) -> bytes:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def fit(texts: list[str], run: int = 10, share: float = 0.5, steps: int = 150, seed: int = 7) -> Model | None:
    """The calibrated model, or None if there is nothing to learn from."""
    # in hash order the first quarter holds each language and length as often as the whole
    texts = sorted((t for t in texts if t and len(t) >= 4 * run), key=_text_hash)
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    made = [at_the_limit(t, rng, run, share) for t in texts[: max(50, len(texts) // 4)]]
    rows = texts + made
    y = (exact_shares(*batch_letters(rows), run) >= share).astype(float)
    if y.min() == y.max():
        return None
    held = np.arange(len(rows)) % 4 == 3
    feats = features(rows)
    n = len(rows)
    weight = np.where(held, 0.0, np.where(y > 0, 0.5 / max(y[~held].sum(), 1), 0.5 / max((1 - y)[~held].sum(), 1)))
    order, bucket, bias = np.zeros(len(ORDERS)), np.zeros((len(ORDERS), BUCKETS)), -1.0
    moments = [np.zeros_like(order), np.zeros_like(order), np.zeros_like(bucket), np.zeros_like(bucket), 0.0, 0.0]
    sums = np.array([np.bincount(r, weights=v, minlength=n) if len(r) else np.zeros(n) for r, _, v in feats])
    for t in range(1, steps + 1):
        z = bias + order @ sums
        for k, (row, b, v) in enumerate(feats):
            if len(row):
                z += np.bincount(row, weights=bucket[k, b] * v, minlength=n)
        g = weight * (1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))) - y)
        go = sums @ g + 1e-5 * order
        gb = np.array([np.bincount(b, weights=g[row] * v, minlength=BUCKETS) if len(row) else np.zeros(BUCKETS) for row, b, v in feats])
        gb += 1e-3 * bucket
        g0 = g.sum()
        m = moments
        step = 0.5 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        m[0], m[1] = 0.9 * m[0] + 0.1 * go, 0.999 * m[1] + 0.001 * go * go
        m[2], m[3] = 0.9 * m[2] + 0.1 * gb, 0.999 * m[3] + 0.001 * gb * gb
        m[4], m[5] = 0.9 * m[4] + 0.1 * g0, 0.999 * m[5] + 0.001 * g0 * g0
        order -= step * m[0] / (np.sqrt(m[1]) + 1e-8)
        bucket -= 0.05 * step * m[2] / (np.sqrt(m[3]) + 1e-6)
        bias -= step * m[4] / (np.sqrt(m[5]) + 1e-8)
    model = Model(order, bucket, float(bias))
    z = model.margin(feats, n)[held]
    model.slope, model.shift = platt(z, y[held])
    return model


def platt(z: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the calibration, by Newton steps on Platt's smoothed targets."""
    pos, neg = y.sum(), (1 - y).sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(np.abs(z).max(), 1e-9)
    x = np.stack([z / scale, np.ones_like(z)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - target) + 1e-3 * w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / scale), float(w[1])


def training_texts(df: DataFrame, text: str, train_rows: int, least_letters: int) -> list[str]:
    """At most ``train_rows`` texts, the same ones for the same table, chosen by hash."""
    total = df.count()
    every = max(1, total // max(1, train_rows) + 1) if total > train_rows else 1
    c = F.col(text)
    sample = df.where(c.isNotNull() & (F.length(c) >= least_letters))
    if every > 1:
        sample = sample.where(F.pmod(F.xxhash64(c), F.lit(every)) == 0)
    rows = sample.select(c.alias("t")).distinct().orderBy(F.xxhash64("t"), "t").limit(train_rows).collect()
    return sorted({r.t for r in rows}, key=_text_hash)


def _apply(df: DataFrame, text: str, new: list[T.StructField], run_rows) -> DataFrame:
    """Adds columns computed by ``run_rows(list of texts) -> list of arrays``, batch by batch."""
    ship_package(df.sparkSession)
    base = spread(df.drop(*[f.name for f in new]))
    at = base.columns.index(text)
    schema = T.StructType([*base.schema.fields, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, at):
                yield pa.RecordBatch.from_arrays([*b.columns, *run_rows(b.column(at).to_pylist())], names=schema.names)

    return base.mapInArrow(run, schema)


def repeated_share(df: DataFrame, text: str = "content", run: int = 10) -> DataFrame:
    """``df`` with ``n_letters`` and ``repeated_share``, the exact measure, for every row."""

    def rows(texts):
        codes, off = batch_letters(texts)
        return [pa.array(np.diff(off).astype(np.int32)), pa.array(np.round(exact_shares(codes, off, run), 6))]

    return _apply(df, text, [T.StructField("n_letters", T.IntegerType()), T.StructField("repeated_share", T.DoubleType())], rows)


def repetition_scores(df: DataFrame, text: str = "content", train_rows: int = 4000, run: int = 10, share: float = 0.5, least_letters: int = 40, model: Model | None = None) -> DataFrame:
    """``df`` with ``repetition_probability``, the calibrated probability that repetition prevails."""
    model = model or fit(training_texts(df, text, train_rows, least_letters), run, share)

    def rows(texts):
        p = model.probability(texts) if model else np.ones(len(texts))
        return [pa.array(p)]

    return _apply(df, text, [T.StructField("repetition_probability", T.DoubleType())], rows)


def prevailing(df: DataFrame, text: str = "content", train_rows: int = 4000, run: int = 10, share: float = 0.5, least_letters: int = 40) -> DataFrame:
    """Rows with at least ``least_letters`` letters of which at least ``share`` are repeated."""
    scored = repetition_scores(df, text, train_rows, run, share, least_letters)
    likely = scored.where(F.col("repetition_probability") >= CANDIDATE)
    measured = repeated_share(likely, text, run)
    return measured.where((F.col("n_letters") >= least_letters) & (F.col("repeated_share") >= share))
