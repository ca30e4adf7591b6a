"""Near-duplicate documents by consistent weighted sampling.

Shingles are five consecutive words (a shorter text is one shingle); the n-th occurrence of a shingle is an element of its
own, so a text is a weighted set. An element weighs 1 + ln(N / df) / ln N, a scaled inverse document frequency; document
frequencies are counted over the whole corpus in a fixed number of hashed features, as text vectorisers do, so the table
has the same size (2**20 numbers) for any corpus. Improved consistent weighted sampling draws ``bands`` x ``rows`` samples
of each text; texts with a band in common are candidates and are verified on all their elements: linked if their weighted
Jaccard similarity is at least ``threshold``.

Equal texts are one node. In a band's bucket every text is first compared with the bucket's smallest, then, where it is in
another component, with the likeliest of some drawn ones; all texts that are not in one
component after that are compared with each other on all elements, in blocks, so a bucket of copies costs one comparison a
text and no pair of a bucket is left out for its samples. The draws depend on a seed only.

Nulls: null texts, and those without a word, are compared with none and are a class of their own each. A null id takes
part, and its class is the smallest id that is there. Ties, repeated rows: equal texts share a class. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import WORD, Texts, mixed, run_hashes, run_starts, slices, sorted_groups, stretch_hashes, word_hashes
from tidemark.session import release_paths, scratch_mark, scratch_since, settled

SHINGLE = 5
FEATURES = 1 << 20
_BLOCK = 1 << 14
_TABLE = 1 << 16  # prepared draws
_TURNS = 5  # drawn leads that texts in other components meet before the rest of a bucket is compared
_TOGETHER = 2048  # texts of a bucket that are compared at once
_MASK = np.uint64(FEATURES - 1)
_BITS = 16  # of a weight as a whole number
_UNIT = 1 << (_BITS - 1)


def elements(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The elements of each text, sorted, and the texts' bounds among them. The low bits are the shingle's feature."""
    h, doc = word_hashes(t), t.doc_of_word()
    at = run_starts(t, SHINGLE)
    shingles, owner = run_hashes(h, SHINGLE)[at], doc[at]
    short = np.flatnonzero((t.counts() > 0) & (t.counts() < SHINGLE))
    shingles = np.concatenate([shingles, stretch_hashes(h, t.words[short], t.words[short + 1])])
    owner = np.concatenate([owner, short])
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    if len(order):
        new = np.r_[True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])]
        first = np.flatnonzero(new)
        nth = np.arange(len(new)) - np.repeat(first, np.diff(np.r_[first, len(new)]))
        later = np.flatnonzero(nth)
        tagged = mixed(shingles[later] + nth[later].astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        shingles[later] = (tagged & ~_MASK) | (shingles[later] & _MASK)
        if len(later):
            order = np.lexsort((shingles, owner))
            shingles, owner = shingles[order], owner[order]
    return shingles, np.searchsorted(owner, np.arange(t.n + 1))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many texts each feature occurs, in blocks."""
    total = np.zeros(FEATURES, np.uint32)
    for batch in batches:
        for t in slices(batch.column("text")):
            e, bounds = elements(t)
            feature = (e & _MASK).astype(np.int64)
            pair = np.unique(np.repeat(np.arange(t.n), np.diff(bounds)) * FEATURES + feature)
            total += np.bincount(pair % FEATURES, minlength=FEATURES).astype(np.uint32)
    yield from _blocks(total)


def _blocks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = [(k, total[k * _BLOCK:(k + 1) * _BLOCK].astype("<u8").tobytes()) for k in range(len(total) // _BLOCK)
            if total[k * _BLOCK:(k + 1) * _BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())],
                                     names=["block", "counts"])


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, b in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            sums[k] = sums.get(k, 0) + np.frombuffer(b, "<u8")
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                     names=["block", "counts"])


def element_weights(docs: DataFrame) -> np.ndarray:
    """Weight of each feature, counted over all texts: ``FEATURES`` numbers whatever the corpus."""
    schema = "block int, counts binary"
    counted = (docs.select("text").mapInArrow(_count_features, schema)
               .repartition(FEATURES // _BLOCK, "block").mapInArrow(_add_blocks, schema).collect())
    df = np.zeros(FEATURES)
    for k, b in counted:
        df[k * _BLOCK:(k + 1) * _BLOCK] = np.frombuffer(b, "<u8")
    n = max(docs.count(), 2)
    return (1 + np.log((1 + n) / (1 + np.minimum(df, n))) / np.log(1 + n)).astype(np.float32)


def _whole(weights: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(weights.astype(np.float64) * _UNIT), 2**_BITS - 1).astype(np.uint64)


class Sampler:
    """Improved consistent weighted sampling with prepared gamma and uniform draws."""

    def __init__(self, weights: np.ndarray, bands: int, rows: int, seed: int):
        self.bands, self.rows = bands, rows
        self.whole, self.log_weight = _whole(weights), np.log(_whole(weights) / _UNIT).astype(np.float32)
        rng = np.random.default_rng(seed)
        r = rng.gamma(2, 1, _TABLE)
        beta, c = rng.random(_TABLE), rng.gamma(2, 1, _TABLE)
        self.r, self.inverse, self.beta = (x.astype(np.float32) for x in (r, 1 / r, beta))
        self.rest = (np.log(c) - r + r * beta + 64).astype(np.float32)  # moved above zero, where floats sort as integers
        self.turns = rng.integers(1 << 62, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, e: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One sample of each set per column: the hash of the element with the least value. Sets are not empty."""
        lw = self.log_weight[(e & _MASK).astype(np.int64)]
        name = e >> np.uint64(32)
        out = np.empty((len(starts), len(self.turns)), np.uint32)
        for j, turn in enumerate(self.turns):
            k = ((e * turn) >> np.uint64(48)).astype(np.intp)
            draw = lambda table: table.take(k, mode="clip")  # noqa: E731, B023
            level = draw(self.inverse)
            level *= lw
            level += draw(self.beta)
            np.floor(level, out=level)
            level *= draw(self.r)
            value = draw(self.rest)
            value -= level
            np.maximum(value, 0, out=value)
            key = (value.view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
            out[:, j] = np.minimum.reduceat(key, starts).astype(np.uint32)
        return out

    def band_keys(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts with elements, their band keys and their samples."""
        e, bounds = elements(t)
        some = np.flatnonzero(np.diff(bounds))
        if not len(some):
            return some, np.zeros((0, self.bands), np.int64), np.zeros((0, self.bands * self.rows), np.uint32)
        samples = self.samples(e, bounds[some])
        s = samples.astype(np.uint64).reshape(len(some), self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25), s.shape[:2])
        for j in range(self.rows):
            key = mixed(key + s[:, :, j] * np.uint64(0x8CB92BA72F3D8DD7))
        return some, key.view(np.int64), samples


def _signed(texts: pa.Array, sampler: Sampler) -> pa.Array:
    bands: list[np.ndarray | None] = [None] * len(texts)
    samples: list[bytes | None] = [None] * len(texts)
    for t in slices(texts):
        for i, k, s in zip(*sampler.band_keys(t)):
            bands[t.first + i], samples[t.first + i] = k, s.tobytes()
    return pa.StructArray.from_arrays([pa.array(bands, pa.list_(pa.int64())), pa.array(samples, pa.binary())], ["bands", "samples"])


def _least_agreeing(n: int, threshold: float) -> int:
    return math.ceil(n * (threshold - 2.5 * math.sqrt(threshold * (1 - threshold) / n)))


def _other_leads(labelled: DataFrame, samples: DataFrame, turn: int, least: int) -> DataFrame:
    """For each text of a bucket with several components, the drawn texts of its buckets that are in another component
    than itself: of these, the one whose samples agree most. One pair a text and turn at most."""

    @F.arrow_udf("int")
    def agree(first: pa.Array, second: pa.Array) -> pa.Array:
        read = lambda x: np.frombuffer(b"".join(x.to_pylist()), np.uint32).reshape(len(x), -1)
        return pa.array((read(first) == read(second)).sum(1).astype(np.int32)) if len(first) else pa.array([], pa.int32())

    leads = labelled.groupBy("bucket").agg(
        F.min("component").alias("x"), F.max("component").alias("y"),
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "component")).alias("lead")).where("x < y")
    pairs = labelled.join(leads.select("bucket", "lead"), "bucket").where("component <> lead.component").select(
        F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
    met = (pairs.join(samples.withColumnsRenamed({"node": "a", "samples": "sa"}), "a")
           .join(samples.withColumnsRenamed({"node": "b", "samples": "sb"}), "b").select("a", "b", agree("sa", "sb").alias("agree")))
    return met.where(F.col("agree") >= least).groupBy("b").agg(F.max(F.struct("agree", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def _alike(elements: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each of the left texts with the right ones whose weighted Jaccard similarity is at least the threshold."""
    low = np.int64(2**_BITS - 1)
    weight = np.array([int((e & low).sum()) for e in elements], np.float64)
    sizes = np.array([len(elements[k]) for k in right])
    flat = np.concatenate([elements[k] for k in right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(right)), sizes)[order]
    for i in left:
        e = elements[i]
        first, last = np.searchsorted(flat, e), np.searchsorted(flat, e, "right")
        n = last - first
        at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        both = np.bincount(owner[at], np.repeat((e & low).astype(np.float64), n), len(right))
        yield i, np.flatnonzero(both >= threshold * (weight[i] + weight[right] - both))


def _across(labelled: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: a link of each two components that have one between texts of one bucket. Every pair of texts in one bucket
    but not in one component is compared on all elements, in blocks; only links leave a block."""
    sizes = labelled.groupBy("bucket").agg(F.ceil(F.count("*") / _TOGETHER).cast("int").alias("blocks"))
    placed = labelled.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", "node", F.xxhash64("component").alias("component"), F.least("block", "with").alias("x"),
        F.greatest("block", "with").alias("y"), (F.col("block") <= F.col("with")).alias("in_x"), (F.col("block") >= F.col("with")).alias("in_y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["bucket", "x", "y"]):
            held = g["vector"].combine_chunks()
            flat, ends = held.flatten().to_numpy(), np.r_[0, np.cumsum(held.value_lengths().to_numpy())]
            own = [flat[p:q] for p, q in zip(ends[:-1], ends[1:])]
            left, right = (np.flatnonzero(g[c].to_numpy()) for c in ("in_x", "in_y"))
            if not len(left) or not len(right):
                continue
            component, node = g["component"].to_numpy(), g["node"].to_pylist()
            links: dict[tuple[int, int], list[bytes]] = {}
            for i, met_here in _alike(own, left, right, threshold):
                for k in right[met_here]:
                    if component[i] != component[k]:
                        links.setdefault(tuple(sorted((component[i], component[k]))), sorted((node[i], node[k])))
            yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in links.values()], pa.binary()) for c in (0, 1)], names=["a", "b"])

    keys = ["bucket", "x", "y"]
    return (met.join(vectors, "node").select(*keys, "node", "component", "in_x", "in_y", "vector").repartition(*keys)
            .sortWithinPartitions(*keys, "node").mapInArrow(compare, "a binary, b binary").distinct())


def _vectors(texts: pa.Array, sampler: Sampler) -> pa.Array:
    """The elements of each text as whole numbers that end with their weight."""
    out = []
    for t in slices(texts):
        e, bounds = elements(t)
        feature = (e & _MASK).astype(np.int64)
        e = ((e >> np.uint64(20)) << np.uint64(_BITS)) | sampler.whole[feature]
        out += [e[bounds[k]:bounds[k + 1]].view(np.int64) for k in range(t.n)]
    return pa.array(out, pa.list_(pa.int64()))


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs of texts whose weighted Jaccard similarity is at least the threshold."""
    weight = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda s, e: s + e.bitwiseAND(F.lit(2**_BITS - 1)))
    weighed = vectors.select("node", "vector", weight("vector").alias("weight"))
    met = (pairs.join(weighed.withColumnsRenamed({"node": "a", "vector": "va", "weight": "wa"}), "a")
           .join(weighed.withColumnsRenamed({"node": "b", "vector": "vb", "weight": "wb"}), "b"))
    alike = met.where(F.least("wa", "wb") >= threshold * F.greatest("wa", "wb")).select(
        "a", "b", weight(F.array_intersect("va", "vb")).alias("both"), (F.col("wa") + F.col("wb")).alias("sum"))
    return alike.where(F.col("both") >= threshold * (F.col("sum") - F.col("both")))


def text_key(text: str = "text"):
    """128 bits of a text; a null text has those of an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _with(found: DataFrame, more: DataFrame) -> DataFrame:
    """The known components, one link a node, and more links."""
    return found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more.select("a", "b"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, bands: int = 20, rows: int = 5, seed: int = 5) -> DataFrame:
    """``doc_id, node, component, class_id`` of every document: the smallest id of the texts it is linked to, directly or through others."""
    spark, start = docs.sparkSession, scratch_mark()
    table = docs.select("doc_id", "text")
    sampler = spark.sparkContext.broadcast(Sampler(element_weights(table), bands, rows, seed))

    @F.arrow_udf("struct<bands: array<long>, samples: binary>")
    def band_keys(texts: pa.Array) -> pa.Array:
        return _signed(texts, sampler.value)

    @F.arrow_udf("array<long>")
    def vector(texts: pa.Array) -> pa.Array:
        return _vectors(texts, sampler.value)

    signed = settled(table.select("doc_id", text_key().alias("node"), band_keys("text").alias("s")).select("doc_id", "node", "s.*"))
    # equal texts have equal bands: members and samples are told apart by the node alone
    members = signed.where("bands is not null").select("node", F.posexplode("bands").alias("band", "bucket")).distinct()
    buckets = members.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last")
    members = settled(members.join(buckets.select("bucket", "lead"), "bucket"))
    samples = signed.where("samples is not null").select("node", "samples").distinct()
    chosen = members.select("node").distinct()
    vectors = settled(table.select(text_key().alias("node"), "text").join(chosen, "node").select("node", vector("text").alias("vector"))
                      .groupBy("node").agg(F.first("vector").alias("vector")))
    first = members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    mark = scratch_mark()
    found = components(settled(_verified(first, vectors, threshold).select("a", "b")))
    for turn in range(_TURNS + 1):
        release_paths(spark, scratch_since(mark)[:-1])  # only the components' table is read from here on
        labelled = settled(members.join(found, "node", "left").select("bucket", "band", "node", F.coalesce("component", "node").alias("component")))
        if turn == _TURNS:
            break
        more = settled(_verified(_other_leads(labelled, samples, turn, _least_agreeing(bands * rows, threshold)), vectors, threshold).select("a", "b"))
        if more.isEmpty():
            break
        found = components(_with(found, more))
    mixed_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    more = settled(_across(labelled.join(mixed_buckets, "bucket"), vectors, threshold))
    whole = components(_with(found, more))
    nodes = signed.join(whole, "node", "left").select(
        "doc_id", "node", F.when(F.col("bands").isNotNull(), F.coalesce("component", "node")).alias("component"))
    nodes = settled(nodes)
    release_paths(spark, scratch_since(start)[:-1])
    least = nodes.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return nodes.join(least, "component", "left").select(
        "doc_id", "node", "component", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id; of equal rows, one. Documents
    without a word all stay."""
    classes = settled(near_duplicates(docs, **how).where("component is not null and doc_id <=> class_id"))
    one = classes.groupBy("component").agg(F.min("node").alias("node"), F.first("class_id").alias("id"), F.count("*").alias("n"))
    own = docs.withColumn("__node", text_key())
    worded = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) > 0
    one = one.select(F.col("id").alias("__id"), F.col("node").alias("__n"), F.col("n").alias("__rows"))
    kept = own.where(worded).join(one, own["doc_id"].eqNullSafe(one["__id"]) & (own["__node"] == one["__n"]))
    # only rows that are there more than once are ranked
    nth = F.row_number().over(W.partitionBy("__node", "__id").orderBy("__node"))
    several = kept.where("__rows > 1").withColumn("__nth", nth).where("__nth = 1")
    return kept.where("__rows = 1").select(*docs.columns).unionAll(several.select(*docs.columns)).unionAll(
        own.where(~worded).select(*docs.columns))
