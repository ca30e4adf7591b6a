"""Language identification with a string kernel.

Texts are compared by the byte n-grams (1 to 4, ASCII lower case) that occur in them at all: the blended-spectrum
presence kernel, divided by the texts' own norms. A bounded sample of the learnable rows gives landmarks; the Nyström map
onto them turns kernel ridge regression, one language against the rest, into a linear solve. Presence vectors are hashed
to ``DIMENSIONS`` places, so landmark products and class weights fold into one matrix and a batch of texts is scored by
one matrix product.

Only the fit uses a sample (``per_language`` ids of each language with the smallest hashes, whatever the language's share);
every row is predicted. Ids are drawn before any text is moved: what is shuffled is an id a row, what is broadcast and
collected is ``per_language`` ids and 2 kB vectors a language, as the model itself has a class for each. Landmarks are dealt
to the languages in turn, at least two each. Nulls: a null text, or one without a letter, is ``und`` with score 0; rows with
a null language, id or text teach nothing. Very long texts are cut nowhere: their presence vectors fill up, and one such
text is held in memory at a time. Repeated rows teach once; rows that share an id and language teach by their smallest text.
Repeated rows are predicted each. With nothing to learn from every row is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.text import Texts, mixed, slices

DIMENSIONS = 1 << 14
_LONGEST = 4
_ROWS = 256  # texts in one matrix product
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def presence(t: Texts) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of presence rows (bool) of the texts, with the number of their first text."""
    for low in range(0, t.n, _ROWS):
        high = min(t.n, low + _ROWS)
        a, b = t.bounds[low], t.bounds[high]
        size = np.diff(t.bounds[low:high + 1])
        row = np.repeat(np.arange(high - low) * DIMENSIONS, size)
        left = np.repeat(t.bounds[low + 1:high + 1], size) - np.arange(a, b)  # bytes up to the text's end
        out = np.zeros((high - low) * DIMENSIONS, bool)
        byte = _LOWER[t.data[a:b]]
        run = byte + np.uint64(1)
        for n in range(1, _LONGEST + 1):
            if n > 1:
                run = run[:-1] * np.uint64(257) + byte[n - 1:] + np.uint64(1)
            fits = left[:len(run)] >= n
            place = (run * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(DIMENSIONS)
            out[(row[:len(run)] + place.astype(np.int64))[fits]] = True
        yield t.first + low, out.reshape(-1, DIMENSIONS)


@dataclass
class KernelRidge:
    languages: list[str]
    weights: np.ndarray  # DIMENSIONS x languages: landmarks, Nyström map and ridge coefficients in one

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        best, top = [], []
        for t in slices(texts):
            for _, rows in presence(t):
                x = rows.astype(np.float32)
                f = (x @ self.weights) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
                k = f.argmax(1)
                best.append(k)
                top.append(np.clip((1 + f[np.arange(len(k)), k]) / 2, 0, 1))
        return (np.concatenate(best), np.concatenate(top)) if best else (np.zeros(0, np.int64), np.zeros(0))


def _packed(texts: pa.Array) -> pa.Array:
    return pa.array([np.packbits(r).tobytes() for t in slices(texts) for _, rows in presence(t) for r in rows], pa.binary())


def drawn_texts(learnable: DataFrame, per_language: int) -> DataFrame:
    """``lang, n, text``: of each language the ids with the ``per_language`` smallest hashes, numbered; only their texts move."""
    # the rank trims every task's ids before they are shuffled by language
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    drawn = learnable.select("lang", "doc_id").distinct().withColumn("n", rank).where(F.col("n") <= per_language)
    found = learnable.select("lang", "doc_id", "text").join(F.broadcast(drawn), ["lang", "doc_id"])
    return found.groupBy("lang", "doc_id", "n").agg(F.min("text").alias("text")).drop("doc_id")


def fit(learnable: DataFrame, per_language: int = 400, landmarks: int = 256, ridge: float = 1e-3) -> KernelRidge | None:
    """Learn from ``doc_id, text, lang``: ``per_language`` ids of each language, drawn by hash. None without rows."""

    @F.arrow_udf("binary")
    def packed(texts: pa.Array) -> pa.Array:
        return _packed(texts)

    sample = drawn_texts(learnable, per_language).select("lang", "n", packed("text").alias("x")).collect()  # 2 kB a row
    if not sample:
        return None
    sample.sort(key=lambda r: (r.n, r.lang))
    x = np.stack([np.unpackbits(np.frombuffer(r.x, np.uint8)) for r in sample]).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    languages = sorted({r.lang for r in sample})
    y = np.where(np.array([r.lang for r in sample])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    marks = np.unique(x[:max(landmarks, 2 * len(languages))], axis=0)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    z = np.c_[(x @ marks.T).astype(np.float64) @ whiten]
    share = np.where(y > 0, 1 / np.maximum((y > 0).sum(0), 1), 1 / np.maximum((y < 0).sum(0), 1))  # classes weigh alike
    solved = [np.linalg.solve((z * share[:, [c]]).T @ z + ridge * np.eye(z.shape[1]), (z * share[:, [c]]).T @ y[:, c])
              for c in range(len(languages))]
    return KernelRidge(languages, (marks.T @ (whiten @ np.stack(solved, axis=1))).astype(np.float32))


def predict(model: KernelRidge | None, text: str | Column = "text") -> Column:
    """A struct ``lang_pred, score``; ``und`` and 0 where the text has no letter."""
    text = F.col(text) if isinstance(text, str) else text
    nothing = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return nothing

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        k, top = model.predict(texts)
        names = pa.array(model.languages).take(pa.array(k))
        return pa.StructArray.from_arrays([names, pa.array(top.astype(np.float64))], ["lang_pred", "score"])

    return F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), of(text)).otherwise(nothing)


def identify(docs: DataFrame, folds: int = 4, out: int = 2, **how) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from rows whose crc32(id) does not leave ``out`` modulo ``folds``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == out, F.lit(False))
    learnable = docs.where(~held & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    model = fit(learnable, **how)
    return docs.select("doc_id", held.alias("held_out"), predict(model).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
