"""Letters of texts as flat numpy arrays, for whole Arrow batches at once.

A letter is a letter or digit of any script; the letters of a text are the lower-cased text
stripped of everything else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_table: list[np.ndarray] = []


def alnum_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _table:
        t = np.zeros(0x110000, dtype=bool)
        t[: 0xD800] = [chr(c).isalnum() for c in range(0xD800)]
        t[0xE000:0x40000] = [chr(c).isalnum() for c in range(0xE000, 0x40000)]
        _table.append(t)
    return _table[0]


def letters(text: str | None) -> str:
    return "".join(filter(str.isalnum, text.lower())) if text else ""


def batch_letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all letters, and offsets: text i has ``codes[off[i]:off[i + 1]]``."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    joined = "\x00".join([t.replace("\x00", " ") if t else "" for t in texts]).lower()
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.flatnonzero(cp == 0)
    keep = alnum_table()[cp]
    upto = np.cumsum(keep)
    off = np.empty(n + 1, np.int64)
    off[0], off[n] = 0, upto[-1] if len(upto) else 0
    off[1:n] = upto[ends]
    return cp[keep], off


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(codes: np.ndarray, positions: tuple[int, ...]) -> np.ndarray:
    """A 64-bit hash for each start, of the code points at start + p for p in positions.

    Windows may cross texts; the caller masks these by offsets.
    """
    span = positions[-1] + 1
    n = len(codes) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    for p in positions:
        h *= base
        h += c[p : p + n]
    return mix(h)


def starts_within(off: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """All window starts that stay in one text, with the number of the text."""
    count = np.maximum(np.diff(off) - span + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    start = np.arange(len(doc)) - np.repeat(first, count) + np.repeat(off[:-1], count)
    return start, doc


def slices(batch: pa.RecordBatch, column: int, most: int = 400_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` letters of a column, or of one longer text."""
    size = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros(0)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end
