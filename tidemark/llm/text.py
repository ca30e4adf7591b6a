"""Whole texts as numpy arrays: word bounds, word hashes and hashes of word runs.

A word is ``[^\\x20\\x09-\\x0D]+``. Separators are single bytes of UTF-8, so words are cut on the bytes of an Arrow
column without decoding it. Work goes in slices of about half a megabyte of text, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE = 1 << 19
_PIECE = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_OTHER = 0xD1342543DE82EF95


def bounded_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Let no more than about ``size`` bytes of rows travel to a Python worker at once, however long texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), b, np.uint64)], dtype=np.uint64)[:n]
                 for b in (base, pow(base, -1, 1 << 64)))


_letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


@dataclass
class Texts:
    """Consecutive texts: their bytes, where each starts, and their words."""

    first: int  # row of the batch
    data: np.ndarray  # bytes of all texts
    bounds: np.ndarray  # n_texts + 1 places in data
    starts: np.ndarray  # of words, in data
    ends: np.ndarray
    words: np.ndarray  # n_texts + 1 places in starts

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.words)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def joined(self, k: int) -> str:
        """The words of text k, joined by one space."""
        data = self.data[self.bounds[k]:self.bounds[k + 1]]
        inside = ~_SEPARATOR[data]
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        return np.where(inside, data, 32).astype(np.uint8)[keep].tobytes().rstrip(b" ").decode("utf-8", "replace")


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of large strings with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(column: pa.Array, size: int = SLICE) -> Iterator[Texts]:
    """The texts of a column, about ``size`` bytes at a time and at least one text; nulls are empty texts."""
    column = plain(column)
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at, n = 0, len(column)
    while at < n:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield _cut(at, data[bounds[at]:bounds[upto]], bounds[at:upto + 1] - bounds[at])
        at = upto


def _cut(first: int, data: np.ndarray, bounds: np.ndarray) -> Texts:
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True  # a text's end ends its word
    before = np.r_[False, inside[:-1]] if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.r_[inside[1:], False] if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Texts(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at, longest = 0, max(_PIECE, int((ends - starts).max(initial=0))) + 1
    all_up, all_down = powers(_BASE, longest)
    while at < len(out):  # blocks of spans: little memory for any text
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
        low, high = starts[at], ends[upto - 1]
        up, down = all_up[:high - low + 1], all_down[:high - low + 1]
        total = np.empty(high - low + 1, np.uint64)
        total[0] = 0
        np.cumsum(_letters[data[low:high]] * up[:-1], out=total[1:])
        s, e = starts[at:upto] - low, ends[at:upto] - low
        out[at:upto] = (total[e] - total[s]) * down[s]
        at = upto
    return mixed(out + (ends - starts).astype(np.uint64))


def word_hashes(t: Texts) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes alone."""
    return span_hashes(t.data, t.starts, t.ends)


def owned(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hashes that tell the same value in different texts apart."""
    return mixed(h ^ ((doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)))


def run_hashes(words: np.ndarray, k: int, other: bool = False) -> np.ndarray:
    """A hash of every k consecutive words (text bounds are not looked at): ``len(words) - k + 1`` of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= 8:
        out = words[:n].copy()
        for j in range(1, k):
            out *= np.uint64(_OTHER if other else _BASE)
            out += words[j:n + j]
        return mixed(out)
    up, down = powers(_OTHER if other else _BASE, len(words) + 1)
    total = np.r_[np.uint64(0), np.cumsum(words * up[:-1], dtype=np.uint64)]
    return mixed((total[k:] - total[:-k]) * down[:n])


def run_starts(t: Texts, k: int) -> np.ndarray:
    """Which places of ``run_hashes`` are whole runs of one text: an index array."""
    last = np.repeat(t.words[1:] - k, t.counts())  # last place at which a run fits
    place = np.arange(len(last))
    return np.flatnonzero(place <= last)


def stretch_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each start up to each end."""
    up, down = powers(_OTHER, len(words) + 1)
    total = np.r_[np.uint64(0), np.cumsum(words * up[:-1], dtype=np.uint64)]
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:-step], x[step:]) if len(x) > step else x[:0]
        done += step
    return x


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in rows that are sorted by them; a run may span batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        cols = [table[k].to_numpy() for k in keys]
        change = np.zeros(len(cols[0]), bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        now = tuple(c[0] for c in cols)
        if held and now != last:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        cuts = [0, *np.flatnonzero(change), table.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.concat_tables(held).combine_chunks()
