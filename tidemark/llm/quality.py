"""Quality classifier: regularised quadratic discriminant over statistics of the text.

Each text becomes a vector of transformed statistics (log-scaled shares and means). Per class the mean and covariance of
the labelled vectors are gathered in one aggregation; covariances are shrunk towards a scaled identity, and their
inverse Cholesky factors are kept with the model. A score is the logistic function of the difference of the two
Mahalanobis log densities (with log priors), divided by the number of effective dimensions only if asked for.

Nulls: a null text is scored as an empty one; rows with a null id or label teach nothing; a null id is not held out.
Repeated rows are scored each, repeated labels count each. With no labelled row of a class every score is 0.5 or that
of the other class's prior (1 or 0); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.text import Texts, mixed, slices, word_hashes
from tidemark.session import settled

FEATURES = ("words", "word_bytes", "word_bytes_spread", "upper", "digits", "marks", "symbols", "exclamation", "bars", "stops",
            "lines", "same_as_previous", "distinct_words", "distinct_after_case", "repeated_lines", "bytes_entropy")
_EPS = 1e-3


def _share_of(table: np.ndarray, t: Texts) -> np.ndarray:
    """Number of bytes of each text that the table marks."""
    total = np.r_[0, np.cumsum(table[t.data], dtype=np.int64)]
    return np.diff(total[t.bounds]).astype(float)


def _marks(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_UPPER, _DIGITS = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("0123456789")
_SYMBOLS, _BANG, _BARS, _STOPS, _LINES = _marks("#*$%&|<>"), _marks("!"), _marks("|"), _marks(".?"), _marks("\n")
_PUNCTUATION = _marks("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()))


def _distinct(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Distinct values per document."""
    if not len(h):
        return np.zeros(n)
    keys = np.sort(mixed(h ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(20) | (doc.astype(np.uint64) << np.uint64(44)))
    first = np.r_[True, keys[1:] != keys[:-1]]
    return np.bincount((keys[first] >> np.uint64(44)).astype(np.int64), minlength=n).astype(float)


def statistics(t: Texts) -> np.ndarray:
    """One row of transformed statistics per text; an empty text has defined values, too."""
    n = t.n
    doc, h = t.doc_of_word(), word_hashes(t)
    size = np.maximum(np.diff(t.bounds), 1).astype(float)
    words = t.counts().astype(float)
    some = np.maximum(words, 1)
    width = (t.ends - t.starts).astype(float)
    mean = np.bincount(doc, width, n) / some
    spread = np.sqrt(np.maximum(np.bincount(doc, width * width, n) / some - mean * mean, 0))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    # lines, as runs of bytes between line breaks, by a hash of their words
    breaks = np.r_[0, np.cumsum(t.data == 10)]
    line = breaks[t.starts] + doc  # a text's end ends a line
    if len(line):
        opens = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
        place = np.arange(len(h)) - np.repeat(opens, np.diff(np.r_[opens, len(h)]))
        of_line = np.add.reduceat(mixed(h + place.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)), opens)
        lines, line_kinds = np.bincount(doc[opens], minlength=n), _distinct(doc[opens], of_line, n)
    else:
        lines, line_kinds = np.zeros(n), np.zeros(n)
    # entropy of the bytes, by counts of (text, byte)
    owner = np.repeat(np.arange(n), np.diff(t.bounds))
    entropy = np.zeros(n)
    for low in range(0, n, 2048):
        high = min(n, low + 2048)
        a, b = t.bounds[low], t.bounds[high]
        c = np.bincount((owner[a:b] - low) * 256 + t.data[a:b], minlength=(high - low) * 256).reshape(-1, 256)
        p = c / np.maximum(c.sum(1, keepdims=True), 1)
        entropy[low:high] = -(p * np.log(np.where(p > 0, p, 1))).sum(1)
    letters = np.maximum(size - _share_of(_PUNCTUATION, t) - _share_of(_DIGITS, t), 1)
    share = lambda x, whole: np.log(_EPS + x / whole)
    kinds = _distinct(doc, h, n)
    columns = [
        np.log1p(words), np.log1p(mean), np.log1p(spread), share(_share_of(_UPPER, t), letters), share(_share_of(_DIGITS, t), size),
        share(_share_of(_PUNCTUATION, t), size), share(_share_of(_SYMBOLS, t), size), share(_share_of(_BANG, t), some),
        share(_share_of(_BARS, t), some), share(_share_of(_STOPS, t), some), share(_share_of(_LINES, t), some),
        share(np.bincount(doc, same, n), some), np.log(np.maximum(kinds, 1)) - np.log(some),
        np.log(np.maximum(kinds, 1)) / np.log1p(some), share(lines - line_kinds, np.maximum(lines, 1)), entropy,
    ]
    return np.stack(columns, axis=1)


def _features(texts: pa.Array) -> pa.Array:
    parts = [statistics(t) for t in slices(texts)]
    flat = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
    return pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * len(FEATURES), pa.array(flat.ravel()))


def features(text: str | Column = "text") -> Column:
    """The statistics of a text column, as ``array<double>``."""

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return _features(texts)

    return of(text)


def held_out(folds: int, doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds == 0, F.lit(False))


@dataclass
class Discriminant:
    """Two Gaussians with cached inverse Cholesky factors."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    offset: float  # difference of log priors and log determinants, or the constant logit

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            logit = np.full(len(x), self.offset)
        else:
            z = np.clip((x - self.centre) / self.scale, -12, 12)
            d0, d1 = ((((z - m) @ f.T) ** 2).sum(1) for m, f in zip(self.means, self.factors))
            logit = self.offset + (d0 - d1) / 2
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and label: count, sums and sums of products, one value a row."""
    d = len(FEATURES)
    total = {}
    for batch in batches:
        x = batch.column("f").flatten().to_numpy().reshape(-1, d)
        y = batch.column("quality").to_numpy()
        for label in np.unique(y):
            rows = np.c_[np.ones((y == label).sum()), x[y == label]]
            total[label] = total.get(label, 0) + rows.T @ rows
    for label, m in total.items():
        yield pa.RecordBatch.from_pydict({"quality": np.full(m.size, label, np.int32), "place": np.arange(m.size), "value": m.ravel()})


def fit(labelled: DataFrame, shrinkage: float = 0.05) -> Discriminant:
    """``labelled``: ``f, quality`` (0 or 1). The covariances are mixed with ``shrinkage`` of the identity."""
    d = len(FEATURES)
    sums = (labelled.select("f", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)")
            .mapInArrow(_moments, "quality int, place long, value double")
            .groupBy("quality", "place").agg(F.sum("value").alias("value")).collect())  # 2 (d + 1)^2 rows
    m = np.zeros((2, (d + 1) ** 2))
    for label, place, value in sums:
        m[label, place] = value
    m = m.reshape(2, d + 1, d + 1)
    n = m[:, 0, 0]
    if not n.all():
        return Discriminant(np.zeros(d), np.ones(d), None, None, float(500 * (n[1] > 0) - 500 * (n[0] > 0)))
    both = m.sum(0)
    centre = both[0, 1:] / n.sum()
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / n.sum() - centre**2, 1e-12)) + 1e-6
    means, factors, logdet = [], [], []
    for k in (0, 1):
        mean = m[k, 0, 1:] / n[k]
        cov = (m[k, 1:, 1:] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov + shrinkage * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(cov + 1e-9 * np.eye(d))
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(low))
        logdet.append(2 * np.log(np.diag(low)).sum())
    offset = float(np.log(n[1] / n[0]) + (logdet[0] - logdet[1]) / 2)
    return Discriminant(centre, scale, tuple(means), tuple(factors), offset)


def score(model: Discriminant, f: str | Column = "f") -> Column:
    """The model's score of a column of statistics, 0 to 1."""

    @F.arrow_udf("double")
    def of(rows: pa.Array) -> pa.Array:
        return pa.array(model.scores(rows.flatten().to_numpy().reshape(-1, len(FEATURES))))

    return of(f)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5) -> tuple[Discriminant, DataFrame]:
    """The model learned from the labelled rows that are not held out, and ``doc_id, held_out, f`` of all rows."""
    table = settled(docs.select("doc_id", held_out(folds).alias("held_out"), features().alias("f")))
    known = labels.select("doc_id", "quality").where("doc_id is not null and quality is not null")
    return fit(table.where("not held_out").join(known, "doc_id")), table


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; predicted is 1 from a score of ``least``."""
    model, table = learn(docs, labels, folds)
    return table.select("doc_id", "held_out", score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5, least: float = 0.3) -> DataFrame:
    """The documents with a score of at least ``least``, with all their columns."""
    model, _ = learn(docs, labels, folds)
    return docs.where(score(model, features(F.col("text"))) >= least)
